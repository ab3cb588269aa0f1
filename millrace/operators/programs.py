"""Running untrusted Python programs and SQL in a task: a process for each program, forked from a clean server.

The server is an isolated interpreter with an empty environment, started once a worker. For each program it forks a
process with a folder and files of its own, limits on time, memory, file size and processes, and ends its whole group at
the time limit. Forking takes a millisecond or two, where a new interpreter would take twenty. What a fork costs follows from
what the server has mapped, so it imports few modules with libraries of their own and skips the
start-up files of installed packages, which it knows by their folders alone; a program's input and output are files in memory.

A program that keeps to a plain part of Python can change nothing but its own objects and what it prints. Such programs run one
after another in a process that they share, which saves the fork. What ends there in any way that the process could have a
part in (memory, depth, files, warnings) is run again in a process of its own.
"""

from __future__ import annotations

import ast
import builtins
import json
import os
import re
import select
import site
import sqlite3
import struct
import subprocess
import sys
import time
from dataclasses import dataclass

OUTPUT_MOST = 65_536
# Words of SQL that make a query, scores of a query.
SQL_VERBS = re.compile(r"\b(SELECT|INSERT|UPDATE|DELETE|CREATE|WITH)\b", re.IGNORECASE)
NO_SQL, SQL_FAILS, SQL_RUNS = 0.0, 0.5, 1.0

#: Reads requests and writes replies, JSON after its length. A program's tests are loaded from a module of their own, and
#: their counts come back by a file that is opened before the program starts, so what it prints is never read as a report. Failures
#: are counted, not told.
SERVER = r"""
import atexit, gc, json, os, resource, select, signal, site, sys, time, traceback, types, unittest

calls, replies = os.fdopen(os.dup(0), "rb"), os.fdopen(os.dup(1), "wb")
os.dup2(os.open(os.devnull, os.O_RDWR), 0)
os.dup2(0, 1)
for add in (site.setquit, site.setcopyright, site.sethelper):
    add()
sys.path += sys.argv[1:]
base, made = next((d for d in (os.environ.get("TMPDIR"), "/tmp", "/var/tmp") if d and os.access(d, os.W_OK | os.X_OK)), os.getcwd()), 0


class Counts(unittest.TestResult):
    def _exc_info_to_string(self, err, test):
        return ""


def tested(source, report):
    write, load, result = os.write, unittest.defaultTestLoader.loadTestsFromModule, Counts()
    run = unittest.TestSuite.run
    module = sys.modules["candidate"] = types.ModuleType("candidate")
    try:
        exec(compile(source, "candidate.py", "exec", dont_inherit=True), module.__dict__)
    except SystemExit:
        pass
    run(load(module), result)
    write(report, b"%d %d %d" % (result.testsRun, len(result.failures) + len(result.errors), result.wasSuccessful()))


def child(call, folder, files):
    os.setsid()
    os.chdir(folder)
    for i, f in enumerate(files):
        os.dup2(f, i)
    report = 3
    os.set_inheritable(report, False)
    os.closerange(4, 64)
    gc.enable()
    cpu = int(call["seconds"]) + 1
    for what, most in ((resource.RLIMIT_CPU, cpu), (resource.RLIMIT_AS, call["memory_mb"] << 20), (resource.RLIMIT_FSIZE, call["file_mb"] << 20), (resource.RLIMIT_CORE, 0), (resource.RLIMIT_NPROC, call["processes"])):
        try:
            resource.setrlimit(what, (most, most))
        except (ValueError, OSError):
            pass
    sys.stdin, sys.stdout, sys.stderr = open(0, encoding="utf-8", errors="surrogateescape"), open(1, "w", encoding="utf-8", errors="replace"), open(2, "w", encoding="utf-8", errors="backslashreplace")
    sys.argv, code = ["main.py"], 0
    try:
        if call["tests"]:
            tested(call["program"], report)
        else:
            main = sys.modules["__main__"] = types.ModuleType("__main__")
            exec(compile(call["program"], "main.py", "exec", dont_inherit=True), main.__dict__)
        if "threading" in sys.modules:
            sys.modules["threading"]._shutdown()
    except SystemExit as e:
        code = e.code if isinstance(e.code, int) else 0 if e.code is None else 1
        if code == 1 and e.code != 1:
            print(e.code, file=sys.stderr)
    except BaseException:
        traceback.print_exc()
        code = 1
    try:
        atexit._run_exitfuncs()
        sys.stdout.flush()
    except BaseException:
        code = code or 1
    sys.stderr.flush()
    os._exit(code & 255)


def remove(folder):
    try:
        os.rmdir(folder)
        return
    except OSError:
        pass
    for at, folders, names in os.walk(folder, topdown=False):
        for name in names + folders:
            path = os.path.join(at, name)
            try:
                os.rmdir(path) if name in folders and not os.path.islink(path) else os.unlink(path)
            except OSError:
                pass
    try:
        os.rmdir(folder)
    except OSError:
        pass


gc.collect()
gc.freeze()
gc.disable()  # a collection would touch the pages that a program shares with the server
while len(head := calls.read(8)) == 8:
    call = json.loads(calls.read(int.from_bytes(head, "big")))
    while True:
        folder, made = os.path.join(base, f"run-{os.getpid()}-{made}"), made + 1
        try:
            os.mkdir(folder, 0o700)
            break
        except FileExistsError:
            pass
    files, began = [os.memfd_create("run", os.MFD_CLOEXEC) for _ in range(4)], time.monotonic()
    given = memoryview(call["given"].encode("utf-8", "replace"))
    while given:
        given = given[os.write(files[0], given):]
    os.lseek(files[0], 0, os.SEEK_SET)
    pid = os.fork()
    if not pid:
        try:
            child(call, folder, files)
        finally:
            os._exit(1)
    end = os.pidfd_open(pid)
    late = not select.select([end], [], [], call["seconds"])[0]
    elapsed = time.monotonic() - began
    for stop in (os.killpg, os.kill):
        try:
            stop(pid, signal.SIGKILL)
        except OSError:
            pass
    os.close(end)
    status = os.waitstatus_to_exitcode(os.waitpid(pid, 0)[1])
    text = [os.pread(f, call["most"], 0).decode("utf-8", "replace") for f in files[1:]]
    for f in files:
        os.close(f)
    remove(folder)
    reply = {"stdout": "" if late else text[0], "stderr": "timeout" if late else text[1], "report": text[2], "timed_out": late, "code": -1 if late else status, "elapsed": call["seconds"] if late else elapsed}
    body = json.dumps(reply).encode()
    replies.write(len(body).to_bytes(8, "big") + body)
    replies.flush()
"""

#: Runs plain programs one after another, each in a module of its own. Says for each whether what came of it can stand.
SHARED = r"""
import gc, io, json, os, resource, sys, traceback, types, warnings

memory_mb = int(sys.argv[1])
for what, most in ((resource.RLIMIT_AS, memory_mb << 20), (resource.RLIMIT_FSIZE, 0), (resource.RLIMIT_CORE, 0)):
    try:
        resource.setrlimit(what, (most, most))
    except (ValueError, OSError):
        pass
calls, replies = os.fdopen(os.dup(0), "rb"), os.fdopen(os.dup(1), "wb")
os.dup2(os.open(os.devnull, os.O_RDWR), 0)
os.dup2(0, 1)
os.chdir("/")
warnings.simplefilter("error")
own = ArithmeticError, AssertionError, AttributeError, EOFError, LookupError, NameError, StopIteration, TypeError, ValueError
gc.collect()
gc.freeze()


def run(call, main):
    said, told = io.BytesIO(), io.BytesIO()
    sys.stdin = io.TextIOWrapper(io.BytesIO(call["given"].encode("utf-8", "replace")), "utf-8", "surrogateescape")
    sys.stdout, sys.stderr = io.TextIOWrapper(said, "utf-8", "replace"), io.TextIOWrapper(told, "utf-8", "backslashreplace")
    code, good = 0, True
    try:
        exec(compile(call["program"], "main.py", "exec", dont_inherit=True), main.__dict__)
    except SystemExit as e:
        code = e.code if isinstance(e.code, int) else 0 if e.code is None else 1
        if code == 1 and e.code != 1:
            print(e.code, file=sys.stderr)
    except Exception as e:
        code, seen = 1, e
        while seen is not None:
            good, seen = good and (isinstance(seen, own) or type(seen) in (Exception, RuntimeError)), seen.__context__
        if good:
            traceback.print_exception(e.with_traceback(e.__traceback__.tb_next))
    except BaseException:
        good = False
    sys.stdout.flush()
    sys.stderr.flush()
    good = good and said.tell() <= call["file_mb"] << 20 and told.tell() <= call["file_mb"] << 20
    most = call["most"]
    return {"good": good, "stdout": said.getvalue()[:most].decode("utf-8", "replace"), "stderr": told.getvalue()[:most].decode("utf-8", "replace"), "code": code & 255}


def reply(body):
    replies.write(len(body).to_bytes(8, "big") + body)
    replies.flush()


reply(b"{}")
while len(head := calls.read(8)) == 8:
    call, main = json.loads(calls.read(int.from_bytes(head, "big"))), types.ModuleType("__main__")
    reply(json.dumps(run(call, main)).encode())
    del call, main
    reply(b"{}")  # what it held is freed, so that the next one's time is its own
"""

# What a plain program may hold: no classes, generators, context managers, modules besides two, or attributes besides these. So it
# reaches no object that outlives it, and leaves nothing that would act later. It catches only errors of its own making.
NODES = "Module Expr Assign AugAssign AnnAssign For While If Break Continue Pass Assert Raise Return FunctionDef Lambda arguments arg Global Nonlocal Delete Try ExceptHandler Call keyword Starred Name Attribute Subscript Slice Constant JoinedStr FormattedValue BinOp UnaryOp BoolOp Compare IfExp NamedExpr Tuple List Set Dict ListComp SetComp DictComp GeneratorExp comprehension Import ImportFrom alias"
PLAIN_NODES = frozenset([getattr(ast, n) for n in NODES.split()] + [c for kind in (ast.operator, ast.unaryop, ast.boolop, ast.cmpop, ast.expr_context) for c in kind.__subclasses__()])
PLAIN_MODULES = {
    "sys": frozenset("stdin stdout exit maxsize".split()),
    "math": frozenset("ceil comb copysign cos cosh degrees dist e exp fabs factorial floor fmod frexp fsum gamma gcd hypot inf isclose isfinite isinf isnan isqrt lcm ldexp lgamma log log10 log1p log2 modf nan perm pi pow prod radians sin sinh sqrt tan tanh tau trunc".split()),
}
METHODS = "read readline readlines write add append bit_length capitalize casefold center clear copy count difference difference_update discard encode decode endswith expandtabs extend find fromkeys get index insert intersection isalnum isalpha isascii isdecimal isdigit islower isnumeric isspace istitle isupper issubset issuperset items join keys ljust lower lstrip partition pop popitem remove removeprefix removesuffix replace reverse rfind rindex rjust rpartition rsplit rstrip setdefault sort split splitlines startswith strip swapcase symmetric_difference title union update upper values zfill"
ATTRIBUTES = PLAIN_MODULES["sys"] | PLAIN_MODULES["math"] | frozenset(METHODS.split())
CAUGHT = frozenset("ArithmeticError AssertionError AttributeError EOFError IndexError KeyError LookupError NameError OverflowError StopIteration TypeError UnboundLocalError ValueError ZeroDivisionError".split())
FUNCTIONS = "abs all any ascii bin bool bytes callable chr complex dict divmod enumerate filter float frozenset hash hex input int isinstance issubclass iter len list map max min next oct ord pow print range repr reversed round set slice sorted str sum tuple zip"
BUILTINS = CAUGHT | frozenset(FUNCTIONS.split()) | {"NotImplemented", "Ellipsis", "Exception", "RuntimeError", "SystemExit", "__name__"}
OTHER_NAMES = (frozenset(dir(builtins)) | {"exit", "quit", "copyright", "credits", "license", "help"}) - BUILTINS


def _free(*names: str | None) -> bool:
    """Whether names may be bound: what is caught by its name must keep it."""
    return all(n is None or not (n in CAUGHT or n.startswith("__")) for n in names)


def _plain(x: ast.AST) -> bool:
    kind = type(x)
    if kind is ast.Name:
        if type(x.ctx) is not ast.Load:
            return _free(x.id)
        return x.id in BUILTINS or not (x.id in OTHER_NAMES or x.id.startswith("__"))
    if kind is ast.Attribute:
        return x.attr in ATTRIBUTES and type(x.ctx) is ast.Load
    if kind is ast.Import:
        return all(a.name in PLAIN_MODULES and _free(a.asname) for a in x.names)
    if kind is ast.ImportFrom:
        return not x.level and x.module in PLAIN_MODULES and all(a.name in PLAIN_MODULES[x.module] and _free(a.asname) for a in x.names)
    if kind is ast.ExceptHandler:
        every = x.type.elts if isinstance(x.type, ast.Tuple) else [x.type]
        return _free(x.name) and all(isinstance(e, ast.Name) and e.id in CAUGHT for e in every)
    if kind is ast.Try:
        return not x.finalbody
    if kind in (ast.FunctionDef, ast.arg):
        return _free(x.name if kind is ast.FunctionDef else x.arg)
    return kind in PLAIN_NODES


def plain(tree: ast.AST | None) -> bool:
    """Whether a program's tree keeps to the plain part of Python."""
    return tree is not None and all(map(_plain, ast.walk(tree)))


@dataclass
class Limits:
    seconds: float = 5.0
    memory_mb: int = 512
    file_mb: int = 16
    processes: int = 256


@dataclass
class Outcome:
    stdout: str
    stderr: str
    timed_out: bool
    code: int
    elapsed: float
    report: str = ""


class _Process:
    """A process that answers calls, JSON after its length; it is started when needed, and again if a program has brought it down."""

    def __init__(self):
        self.process = None

    def _start(self, source: str, *arguments: str) -> None:
        self.process = subprocess.Popen([sys.executable, "-I", "-S", "-c", source, *arguments], stdin=subprocess.PIPE, stdout=subprocess.PIPE, stderr=subprocess.DEVNULL, env={"PATH": os.defpath, **{k: v for k, v in os.environ.items() if k == "TMPDIR"}}, start_new_session=True)

    def _read(self, n: int, until: float) -> bytes:
        out, pipe = b"", self.process.stdout.fileno()
        while len(out) < n:
            if not select.select([pipe], [], [], max(0.0, until - time.monotonic()))[0]:
                raise TimeoutError("the server doesn't answer")
            part = os.read(pipe, n - len(out))
            if not part:
                raise OSError("the server has gone")
            out += part
        return out

    def _answer(self, until: float) -> dict:
        return json.loads(self._read(struct.unpack(">Q", self._read(8, until))[0], until))

    def _call(self, **call) -> None:
        body = json.dumps(call).encode()
        self.process.stdin.write(struct.pack(">Q", len(body)) + body)
        self.process.stdin.flush()

    def close(self) -> None:
        if self.process is not None:
            self.process.kill()
            for pipe in (self.process.stdin, self.process.stdout):
                try:
                    pipe.close()
                except OSError:
                    pass
            self.process.wait()
            self.process = None


class Shared(_Process):
    """The process that plain programs share."""

    memory_mb = 0

    def run(self, program: str, given: str, limits: Limits) -> Outcome | None:
        """What a plain program gave; None if it must run by itself."""
        try:
            if self.process is None or self.memory_mb != limits.memory_mb:
                self.close()
                self._start(SHARED, str(limits.memory_mb))
                self.memory_mb = limits.memory_mb
            self._answer(time.monotonic() + 30)
            began = time.monotonic()
            self._call(program=program, given=given or "", file_mb=limits.file_mb, most=OUTPUT_MOST)
        except OSError:
            self.close()
            return None
        try:
            got = self._answer(began + limits.seconds)
        except TimeoutError:
            self.close()
            return Outcome("", "timeout", True, -1, limits.seconds)
        except OSError:
            self.close()
            return None
        return Outcome(got["stdout"], got["stderr"], False, got["code"], time.monotonic() - began) if got["good"] else None


class Server(_Process):
    """A server that gives each program a process; plain ones go to the process that they share."""

    def __init__(self):
        super().__init__()
        self.shared = Shared()

    def run_plain(self, program: str, given: str, limits: Limits) -> Outcome:
        """``run`` for a program that is ``plain``."""
        return self.shared.run(program, given, limits) or self.run(program, given, limits)

    def run(self, program: str, given: str, limits: Limits, tests: bool = False) -> Outcome:
        began = time.monotonic()
        if self.process is None:
            self._start(SERVER, *filter(os.path.isdir, site.getsitepackages()))
        try:
            self._call(**vars(limits), program=program, given=given or "", tests=tests, most=OUTPUT_MOST)
            return Outcome(**self._answer(began + limits.seconds + 30))
        except OSError as e:
            self.close()
            return Outcome("", str(e), False, -1, time.monotonic() - began)

    def close(self) -> None:
        super().close()
        self.shared.close()


_own: list[Server] = []


def worker_server() -> Server:
    """The server of this worker process, kept from task to task. It ends with the worker, when its pipe is closed."""
    if not _own:
        _own.append(Server())
    return _own[0]


def run_program(code: str, stdin: str = "", limits: Limits | None = None) -> Outcome:
    """Run one program on an input, with a server of its own."""
    server = Server()
    try:
        return server.run(code, stdin, limits or Limits())
    finally:
        server.close()


def test_counts(spent: Outcome) -> tuple[int, int, bool]:
    """Unit tests run and failed, and whether all went well; without a report nothing ran."""
    said = spent.report.split()
    if spent.timed_out or len(said) != 3 or not all(x.isdigit() for x in said):
        return 0, 0, False
    return int(said[0]), int(said[1]), said[2] == "1"


def sql_score(sql: str, schema: str = "", seconds: float = 5.0) -> float:
    """Score of a query on an empty in-memory database made by ``schema``; a leading "Schema:" line is no part of it."""
    sql = (sql or "").strip()
    if not sql or not SQL_VERBS.search(sql):
        return NO_SQL
    end = time.monotonic() + seconds
    db = sqlite3.connect(":memory:")
    try:
        db.set_progress_handler(lambda: time.monotonic() > end, 10_000)
        try:
            db.executescript(re.sub(r"\ASchema:\n", "", schema or ""))
        except sqlite3.Error:
            pass
        db.execute(sql)
        return SQL_RUNS
    except (sqlite3.Error, sqlite3.Warning):
        return SQL_FAILS
    finally:
        db.close()
