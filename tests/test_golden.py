"""Hand-made cases, one for each branch, and small models in plain Python."""

import itertools
import json

import pytest
from millrace.functions import extract, text
from millrace.operators import dedup, formats, near_index, programs, relevance, scores, split, tokens, verify
from millrace.plans.corpus import Options, build, prepare
from millrace.sources import normalize, readers
from pyspark.sql import functions as F


def values(spark, kind, items, f):
    rows = spark.createDataFrame([(i, x) for i, x in enumerate(items)], f"i long, x {kind}").select("i", f(F.col("x")).alias("y")).collect()
    return [r.y for r in sorted(rows)]


def test_difficulty(spark):
    given = [None, "Easy", "0", "1", "2", "3", "5", "6", "1200", "1201", "2000", "2001", "-5", "1200.0", "competition", "foo", "1_200", ""]
    want = ["unknown", "easy", "easy", "easy", "medium", "hard", "hard", "easy", "easy", "medium", "medium", "hard", "easy", "unknown", "hard", "unknown", "unknown", "unknown"]
    assert values(spark, "string", given, text.difficulty) == want


def test_strip_and_lines(spark):
    given = ["", " a ", " b \n", "\x1cc", None, "a\r\nb\rc\n\n\n\n\nd "]
    assert values(spark, "string", given, text.strip) == [None if g is None else g.strip() for g in given]
    assert values(spark, "string", given[-1:], text.clean_squeezed) == ["a\nb\nc\n\n\nd"]
    odd = ["", "a", "a\n", "a\nb\r\nc\rd", "\n\n", "x\x0by z"]
    assert values(spark, "string", odd, extract.lines) == [x.splitlines() for x in odd]


def test_hash_key(spark):
    given = ["A - b", "ﬁn  É!", "x_1", "", "  ", "日本 ①", "a b"]
    import re
    import unicodedata

    want = [re.sub(r"[^\w\s]", "", re.sub(r"\s+", " ", unicodedata.normalize("NFKC", t).lower())).strip() for t in given]
    assert values(spark, "string", given, text.hash_key) == want


def test_shingles(spark):
    given = ["", "ab", "abc", "aaaa", "a b", "one two  three", "🙂🙂🙂"]

    def plain(t):
        w = t.split()
        return {t[i : i + 3] for i in range(len(t) - 2)} | {" ".join(w[i : i + 2]) for i in range(len(w) - 1)}

    assert [set(x) for x in values(spark, "string", given, text.shingles)] == [plain(t) for t in given]


def test_examples_and_solutions(spark):
    given = [None, "", "{bad", '{"inputs": ["1", "2"], "outputs": ["3"]}', '{"input": "x", "output": "y"}', '[{"input": "a", "output": " b "}, 3]', json.dumps([{"stdin": str(i), "stdout": "o"} for i in range(7)]), "[]", "3", '{"inputs": [1, 2.5], "outputs": [true, "s"]}']
    got = values(spark, "string", given, text.examples_of_json)
    assert [len(x) for x in got] == [0, 0, 0, 1, 1, 1, 5, 0, 0, 2]
    assert got[5][0].output == "b" and got[9][0].input == "1"
    given = [None, " ", "print(1)", '["a", ""]', "7", '{"language": ["x"], "solution": ["s", "t"]}', '[{"solution": ""}, {"code": "c"}]', '"quoted"']
    assert values(spark, "string", given, text.solutions_of_json) == [[], [], ["print(1)"], ["a", ""], [], ["s"], ["c"], []]


def test_pass_at_k(spark):
    cases = [(10, 0, 1), (10, 10, 1), (10, 3, 1), (10, 3, 8), (5, 2, 3)]
    for n, c, k in cases:
        got = spark.range(1).select(scores.pass_at_k(F.lit(n), F.lit(c), k).alias("p")).first().p
        wrong = list(itertools.combinations(range(n), k))
        assert got == pytest.approx(sum(any(i < c for i in x) for x in wrong) / len(wrong))
    assert str(spark.range(1).select(scores.pass_at_k(F.lit(2), F.lit(1), 3).alias("p")).first().p) == "nan"


@pytest.mark.parametrize("total,chunks,kept", [(7, 0, 0), (8, 0, 1), (9, 1, 1), (16, 1, 2), (17, 2, 2)])
def test_packing_lengths(spark, total, chunks, kept):
    rows = [(0, list(range(1, 4))), (1, list(range(4, total - 1)))]  # an end mark each
    df = spark.createDataFrame(rows, "_rid long, ids array<int>")
    flat = [*rows[0][1], 0, *rows[1][1], 0]
    for exact, n in ((False, chunks), (True, kept)):
        got = sorted(tuple(r.input_ids) for r in tokens.pack(df, length=8, keep_exact=exact).collect())
        assert got == sorted(tuple(flat[i * 8 : i * 8 + 8]) for i in range(n))


def test_packing_of_nothing(spark):
    assert tokens.pack(spark.createDataFrame([], "_rid long, ids array<int>"), length=8).count() == 0


def test_mask(spark):
    rows = [(0, "p q", "a b c d e f g h"), (1, "p " * 30, "a"), (2, "p", "a"), (3, " ", "a b c d e f g h i j k"), (4, None, "x")]
    df = spark.createDataFrame(rows, "_rid long, prompt string, response string").withColumn("prompt", F.concat("prompt", F.lit(" ")))
    got = {r._rid: r for r in tokens.mask_prompt(df, length=20).collect()}
    assert set(got) == {0} and got[0].labels[:2] == [-100, -100] and got[0].labels[2:] == got[0].input_ids[2:] and got[0].input_ids[-1] == 0
    assert set(r._rid for r in tokens.mask_prompt(df, length=20, train_on_prompt=True).collect()) == {0, 1}


def greedy(edges, n):
    kept = []
    for i in range(n):
        if not any((k, i) in edges for k in kept):
            kept.append(i)
    return kept


def test_keep_first_is_greedy(spark):
    import random

    rng = random.Random(5)
    for _ in range(3):
        edges = {tuple(sorted(rng.sample(range(30), 2))) for _ in range(25)}
        ids, e = spark.range(30).toDF("id"), spark.createDataFrame(list(edges), "lo long, hi long")
        for one_task in (None, 8, 0):
            assert sorted(r.id for r in dedup.keep_first(ids, e, one_task).collect()) == greedy(edges, 30)
    buckets = {b: rng.sample(range(30), rng.randint(1, 5)) for b in range(14)}
    meet = {(a, c) for m in buckets.values() for a in m for c in m if a < c}
    members = spark.createDataFrame([(i, b) for b, m in buckets.items() for i in m], "id long, bucket long")
    for one_task in (None, 8, 0):
        assert sorted(r.id for r in dedup.keep_first_of_buckets(spark.range(30).toDF("id"), members, one_task).collect()) == greedy(meet, 30)


def test_long_chains_of_copies(spark):
    """1,500 links: every second row stays, whatever the number of rounds."""
    chain = spark.range(1500).selectExpr("id AS lo", "id + 1 AS hi")
    want = list(range(0, 1501, 2))
    assert sorted(r.id for r in dedup.keep_first(spark.range(1501).toDF("id"), chain).collect()) == want
    buckets = chain.selectExpr("lo AS id", "lo AS bucket").union(chain.selectExpr("hi", "lo"))
    assert sorted(r.id for r in dedup.keep_first_of_buckets(spark.range(1501).toDF("id"), buckets).collect()) == want


@pytest.mark.parametrize("threshold", [0.3, 0.6, 0.85, 1.0])
def test_similar_pairs_are_those_of_brute_force(spark, monkeypatch, threshold):
    """Pairs and hits, the latter by tables sent to tasks and by the join; and only beginnings of sets are exploded."""
    rng = __import__("random").Random(11)
    words = [f"w{i}" for i in range(30)] + ["a", "b", "é", "字", "\U0001f600"]
    texts = [" ".join(rng.choice(words) for _ in range(rng.randrange(1, 25))) for _ in range(40)]
    rows = [(i, t) for i, t in enumerate(texts + texts[:5] + ["", "a", "ab", "a b", "a  b", "a b a b", "abc", "abc"])]
    for i, t in rows[:30]:
        parts = t.split(" ")
        parts[rng.randrange(len(parts))] = rng.choice(words)
        rows.append((100 + i, " ".join(parts)))
    sets = {i: dedup._shingles(k) for i, k in rows}
    assert all(len(dedup.shingle_hashes(k)) == len(sets[i]) for i, k in rows)
    alike = lambda x, y: bool(x and y) and len(x & y) / len(x | y) >= threshold
    want = {(i, j): round(len(sets[i] & sets[j]) / len(sets[i] | sets[j]), 9) for i in sets for j in sets if i < j and alike(sets[i], sets[j])}
    df = spark.createDataFrame(rows, "id long, k string").repartition(3)
    got = [(r.lo, r.hi, round(r.similarity, 9)) for r in dedup.similar_pairs(df, threshold).collect()]
    assert sorted(got) == sorted((*p, s) for p, s in want.items()) and want
    mine, held = df.where("id < 100"), df.where("id >= 100 or id = 41")
    near = {i for i in sets if i < 100 and any(alike(sets[i], sets[j]) for j in sets if j >= 100 or j == 41)}
    assert sorted(r.id for r in dedup.similar_to(mine, held, threshold).collect()) == sorted(near)
    monkeypatch.setattr(dedup, "HELD_MOST", 0)
    assert sorted(r.id for r in dedup.similar_to(mine, held, threshold).collect()) == sorted(near) and near


def test_few_shingles_are_sent():
    """Of a set of n, some (1 - threshold) n shingles, in rows of bounded frames; before, all of them were sorted and shuffled twice."""
    levels = type("L", (), {"value": __import__("numpy").zeros(1 << dedup.CELL_BITS, "uint8")})
    key = " ".join(f"w{i}" for i in range(2000))
    n = len(dedup.shingle_hashes(key))
    sent = [f for f in dedup._prefixed(levels, 0.85)([__import__("pandas").DataFrame({"id": range(100), "k": [key] * 100})])]
    assert sum(map(len, sent)) <= 100 * (0.15 * n + 2) and max(map(len, sent)) < dedup.SHINGLES_A_FRAME + n


def test_near_copies_of_odd_rows(spark):
    rows = [(0, "a long text about nothing at all, told twice"), (1, "A long text about nothing at all -- told twice!"), (2, ""), (3, ""), (4, "ab"), (5, None), (6, "something else that is not alike in any way")]
    df = spark.createDataFrame(rows, "_rid long, problem string")
    for method, want in (("minhash", {0, 2, 3, 4, 5, 6}), ("jaccard", {0, 2, 3, 4, 5, 6}), ("exact", {0, 1, 2, 4, 6})):  # the dash leaves two spaces in the key
        assert {r._rid for r in dedup.dedup_near(df, method=method).collect()} == want
    none = df.limit(0)
    assert dedup.decontaminate_near(df, none).count() == 7 and dedup.decontaminate_near(none, df).count() == 0
    assert {r._rid for r in dedup.decontaminate_near(df, df.where("_rid = 1")).collect()} == {2, 3, 4, 5, 6}


@pytest.mark.parametrize("n,sizes", [(1, (1, 0, 0)), (2, (1, 1, 0)), (50, (1, 1, 48)), (1000, (10, 20, 970))])
def test_split_sizes(spark, n, sizes):
    parts = split.split(spark.range(n).select(F.col("id").alias("_rid"), F.col("id").cast("string").alias("problem")), method=None)
    assert tuple(parts[k].count() for k in ("test", "val", "train")) == sizes


def test_filters_by_branch(spark):
    rows = [
        ("taco", "x", ["import pandas as pd"], [], False), ("my_taco", "x", ["ok"], ["html"], True), ("other", "y" * 49, [], [], False), ("other", "y" * 50, [], [], True),
        ("other", "y" * 8000, [], [" dp "], True), ("other", "y" * 8001, [], [], False), ("other", "y" * 60, [], [" HTML"], False), ("other", "y" * 60 + " <html", [], [], False), (None, "y" * 60, None, None, True),
    ]
    df = spark.createDataFrame([(i, *r[:4]) for i, r in enumerate(rows)], "i long, source string, problem string, solutions array<string>, tags array<string>")
    assert {r.i for r in df.transform(relevance.cp_filter()).collect()} == {i for i, r in enumerate(rows) if r[4]}
    assert {r.i for r in df.transform(relevance.cp_filter(need_signal=True)).collect()} == {1, 4}


def test_programs_are_confined():
    out = programs.run_program("import os\nprint('HOME' in os.environ, os.getcwd() != '/')", "", programs.Limits(5))
    assert out.code == 0 and out.stdout.split() == ["False", "True"]
    assert programs.run_program("x = bytearray(10**10)", "", programs.Limits(5)).code != 0
    assert len(programs.run_program("print('a' * 10**6)", "", programs.Limits(5)).stdout) == programs.OUTPUT_MOST
    late = programs.run_program("import time; time.sleep(60)", "", programs.Limits(0.5))
    assert late.timed_out and late.elapsed == 0.5
    assert programs.sql_score("with r as (select 1) select * from r") == 1.0 and programs.sql_score("hello") == 0.0


def test_programs_do_not_see_each_other():
    server = programs.Server()
    try:
        run = lambda code, given="": server.run(code, given, programs.Limits(2))
        assert run("import builtins\nbuiltins.kept = 1\nopen('f', 'w').write('x')").code == 0
        assert run("import os\nprint(os.listdir('.'), 'kept' in dir(__builtins__))").stdout == "[] False\n"
        assert run("print(input(), 'é')", "ü").stdout == "ü é\n"
        assert run("raise SystemExit('no')").code == 1 and run("import sys; sys.exit(3)").code == 3
        assert run("import threading\nthreading.Thread(target=print, args=('late',)).start()").stdout == "late\n"
        assert run("import os; os.kill(os.getppid(), 9)").code == -1  # the server is started again
        assert run("if __name__ == '__main__': print(1)").stdout == "1\n"
        assert run("import os\nif os.fork() == 0:\n while True: pass").code == 0
    finally:
        server.close()


def test_plain_programs_share_a_process_and_give_the_same():
    """What a plain program gives in the shared process is what it gives in one of its own; the rest isn't run there."""
    plain = lambda code: programs.plain(extract.parsed(code))
    told = [("a, b = map(int, input().split())\nprint(a + b)  # x", "1 2"), ("import sys\nfor x in sys.stdin: print(repr(x))", "a\r\né"), ("raise ValueError('no')", ""), ("raise SystemExit(3)", ""), ("input()", ""), ("raise Exception", ""), ("kept = 1", ""), ("print(kept)", "")]
    told += [("try:\n  int('x')\nexcept ValueError as e: print(e)", ""), ("print('a' * 10**6)", ""), ("while True: pass", "")]
    alone = ["x = [0] * 10**10", "def f(n): f(n + 1)\nf(0)", "while True: print('a' * 10**6)"]
    server = programs.Server()
    try:
        seen = lambda r: (r.stdout, r.stderr.splitlines()[-1:], r.timed_out, r.code)
        for code, given in told:
            assert plain(code) and seen(server.shared.run(code, given, programs.Limits(1))) == seen(server.run(code, given, programs.Limits(1))), code
        pid = server.run_plain("print(1)", "", programs.Limits(1)) and server.shared.process.pid
        assert all(server.run_plain(f"print({i})", "", programs.Limits(1)).stdout == f"{i}\n" for i in range(50)) and server.shared.process.pid == pid
        for code in alone:
            assert plain(code) and server.shared.run(code, "", programs.Limits(5)) is None and server.run_plain(code, "", programs.Limits(1)).code != 0
    finally:
        server.close()
    own = "import os;open('f');().__class__;print(getattr(1, 'a'));class A: pass;import sys\nsys.stdin = 1;import sys\nsys.path;import math\nmath.pi = 3;ValueError = Exception;def f(KeyError): pass;import math as ValueError;from sys import modules;exec('1');def f(): yield 1;'{0.a}'.format(1);quit()"
    own = [*own.split(";"), "try: pass\nexcept: pass", "try: pass\nexcept Exception: pass", "try: pass\nfinally: pass", "with a: pass", "__builtins__"]
    assert not any(map(plain, own)) and not plain("print(")


UNIT = "import unittest\nclass T(unittest.TestCase):\n def test_a(self): self.assertEqual(f(), 1)\n def test_b(self): self.assertEqual(f(), 2)"


def test_unit_tests(spark):
    said = "import sys\nprint('Ran 100 tests in 0s\\n\\nOK', file=sys.stderr)\n"
    mains = UNIT + "\nif __name__ == '__main__': unittest.main()"
    rows = [("def f(): return 1", UNIT, 0.5), (said + "def f(): return 1", UNIT, 0.5), (said + "sys.exit(0)", UNIT, 0.0), ("def f(", UNIT, 0.0), ("def f(): return 1", mains, 0.5), ("def f(): return 1", UNIT + "\nunittest.main()", 0.5), ("def f(): return 1", " ", 0.0), ("x = 1", None, 0.0)]
    df = spark.createDataFrame([(i, c, t) for i, (c, t, _) in enumerate(rows)], "i long, code string, test_code string").withColumn("examples", F.array().cast(text.EXAMPLES))
    got = {r.i: r for r in verify.score_programs(df, seconds=5.0).collect()}
    assert [got[i].pass_rate for i in range(len(rows))] == [r for *_, r in rows]
    assert got[6].elapsed == 0 and got[7].elapsed == 5.0 and not got[0].has_examples


def test_runs_are_shared_and_dealt_to_few_tasks(spark):
    """Scores and reasons come from the same runs, a candidate's own tests from earlier ones; tasks don't follow the runs."""
    ex = [{"input": str(i), "output": str(i)} for i in range(3)]
    rows = [(0, "print(input())", ex, ex[:2]), (1, "print(int(input()) % 2)", ex, ex[:2]), (2, "print(", ex, ex), (3, "print(input())", [], ex), (4, "raise ValueError", ex, ex)]
    df = spark.createDataFrame(rows, "i long, code string, examples array<struct<input:string,output:string>>, self_tests array<struct<input:string,output:string>>")
    got = {r.i: (r.pass_rate, r.self_rate, r.passed, r.reason) for r in verify.score_programs(df, seconds=5.0, reasons=True).collect()}
    want = {r.i: r.reason for r in verify.check_programs(df, seconds=5.0).collect()}
    assert {i: g[3] for i, g in got.items()} == want and all(g[2] == (g[3] == "passed") for g in got.values())
    assert [got[i][1] for i in range(5)] == [1.0, 0.0, 0.0, 1.0, 0.0] and round(got[1][0], 3) == 0.667
    units = verify._of_examples(verify._numbered(df.where("i = 0")), F.col("code"), F.col("examples"), 5.0)
    done = []
    verify.outcomes(units.where("place < 3"), 512, done)
    assert verify.outcomes(units, 512, done).count() == 3 and [d.count() for d in done] == [2, 1]
    assert verify._tasks(100, 8) == 8 and verify._tasks(1_500_000, 12) == 384 and verify._tasks(9_000_000, 12) == 2198


def test_solutions_that_hold(spark):
    one, none = UNIT[: UNIT.index("\n def test_b")], []
    shown = [{"input": "", "output": "1"}]
    rows = [
        (0, ["import os; os._exit(0)", "def f(): return 2", "def f(): return 1"], none, one),
        (1, ["def f(): return 2"], none, one),
        (2, ["print(2)", " ", None, "print(1)", "print('1 ')"], shown, ""),
        (3, ["print(2)"], none, ""),
        (4, None, shown, None),
        (5, ["print(2)"], None, None),
        (6, ["print(1)\nraise ValueError"], shown * 2 + [{"input": None, "output": "1\n"}, {"input": "", "output": "not looked at"}], None),
        (7, ["raise ValueError"], [{"input": "", "output": None}], None),
    ]
    df = spark.createDataFrame(rows, "i long, solutions array<string>, examples array<struct<input:string,output:string>>, test_code string").repartition(3)
    got = {r.i: r.solutions for r in verify.keep_verified(df, 5.0).collect()}
    assert got == {0: ["def f(): return 1"], 2: ["print(1)"], 3: ["print(2)"], 5: ["print(2)"], 6: ["print(1)\nraise ValueError"], 7: ["raise ValueError"]}
    assert verify.keep_verified(df.where("i > 99")).isEmpty()


def test_first_failures_and_equal_runs(spark):
    """A failure past many examples; a program that many candidates share runs once on each input."""
    many = [{"input": str(i), "output": str(i + (i == 37))} for i in range(50)]
    rows = [(0, "print(input())", many), (1, "print(input())", many[:20]), (2, "print(input())", []), (3, None, many[:1]), (4, "print(", many[:1]), (5, "while True: pass", many), (6, "print(input() + ' ')", many[:9])]
    rows += [(i, "print(input())", many[:20]) for i in range(10, 200)]
    df = spark.createDataFrame(rows, "i long, code string, examples array<struct<input:string,output:string>>").repartition(4)
    got = {r.i: r.reason for r in verify.check_programs(df, seconds=1.0).collect()}
    assert [got[i] for i in range(7)] == ["wrong_answer_example_38", "passed", "no_examples", "wrong_answer_example_1", "runtime_error_example_1", "timeout_on_example_1", "passed"]
    assert all(got[i] == "passed" for i in range(10, 200))
    units = verify._of_examples(verify._numbered(df.where("i >= 10")), F.col("code"), F.col("examples"), 1.0)
    judged = verify.outcomes(units)
    assert judged.count() == 190 * 20 and judged.select("elapsed").distinct().count() <= 20
    assert verify.check_programs(df.where("i > 999")).isEmpty() and verify.score_programs(df.where("i > 999")).isEmpty()


def test_normalizers_take_anything(spark):
    bare = spark.createDataFrame([(0, None), (1, "")], "_rid long, unrelated string")
    for name in normalize.CP_NORMALIZERS:
        if name != "code_contests":
            assert normalize.normalize(bare, name).count() == 0
    for name in normalize.SE_NORMALIZERS:
        if name != "ultrachat":
            assert normalize.normalize(bare, name, "se").count() == 0
    with pytest.raises(ValueError):
        normalize.normalize(bare, "nothing", "se")
    df = spark.createDataFrame([(0, "p", [("x", None), (None, "y")])], "_rid long, text string, solutions array<struct<solution:string,code:string>>")
    assert normalize.normalize(df, "unheard of").first().solutions == ["x", "y"]


def test_registries_and_readers(spark, tmp_path):
    assert len(readers.source_names()) == 16 and len(readers.source_names("se")) == 18
    assert readers.CP_SOURCES["bigcodebench"].folder("/r") == "/r/bigcode/bigcodebench/v0.1.2"
    spark.range(5).write.parquet(readers.CP_SOURCES["apps"].folder(str(tmp_path)))
    assert readers.read_source(spark, "apps", str(tmp_path), max_rows=3, order_col="id").count() == 3
    assert readers.read_source(spark, "nothing", str(tmp_path)) is None and readers.read_source(spark, "taco", str(tmp_path)) is None
    assert list(readers.read_sources(spark, ["taco", "apps"], str(tmp_path))) == ["apps"]
    with pytest.raises(RuntimeError):
        readers.read_sources(spark, ["taco"], str(tmp_path))
    (tmp_path / "x.jsonl").write_text('{"a": 1}\n\n{"a": broken\n{"a": 2}\n')
    assert sorted(r.a for r in readers.read_jsonl(spark, str(tmp_path / "x.jsonl"), "a int", tolerant=True).collect()) == [1, 2]
    with pytest.raises(Exception):
        readers.read_jsonl(spark, str(tmp_path / "x.jsonl"), "a int").collect()
    readers.write_config({"a": 1}, str(tmp_path / "c.json"))
    assert readers.read_config(str(tmp_path / "c.json")) == {"a": 1}


def test_whole_plan(spark, tmp_path):
    rng = __import__("random").Random(1)
    texts = [" ".join(f"w{rng.randrange(500)}" for _ in range(40)) for _ in range(60)]
    raw = spark.createDataFrame([(i, texts[i % 50], "print(1)", "hard") for i in range(60)], "_rid long, question string, solutions string, difficulty string")
    options = Options(method="exact")
    parts = build({"taco": raw}, options)
    meta = parts["meta"].first()
    assert (meta.n_preprocessed, meta.n_filtered, meta.n_deduplicated, meta.n_test, meta.n_val, meta.n_train) == (60, 60, 50, 1, 1, 48)
    assert prepare({"taco": raw}, str(tmp_path / "out"), options) and not prepare({"taco": raw}, str(tmp_path / "out"), options)
    docs, pairs = (spark.read.json(str(tmp_path / "out" / n)) for n in ("pretrain_train", "sft_train"))
    assert docs.columns == ["text"] and docs.count() == 48 and {"prompt", "response", "difficulty"} <= set(pairs.columns)
    assert pairs.first().response == "print(1)\n```"


def test_pairs_without_solution(spark):
    df = spark.createDataFrame([("p", [" "]), (" ", ["s"]), ("p", None)], "problem string, solutions array<string>").withColumns({"examples": F.array().cast(text.EXAMPLES), "difficulty": F.lit("hard"), "tags": F.array().cast("array<string>")})
    assert all(r.prompt is None and r.response is None for r in formats.cp_pair(df).collect())


def test_rejection_sampling_records(spark):
    records = spark.createDataFrame([(1, "taco", ["old"]), (2, None, ["old"]), (3, "x", ["old"])], "problem_id long, source string, solutions array<string>")
    tried = spark.createDataFrame([(1, 1, "b", True), (1, 0, "a", True), (2, 0, "c", False), (2, 2, "d", True), (3, 0, "e", False), (3, 1, "f", None)], "problem_id long, sample_idx int, code string, verified boolean")
    got = sorted(tuple(r) for r in scores.rft_records(records, tried).select("problem_id", "source", "solutions").collect())
    assert got == [(1, "rft/taco", ["a"]), (2, "rft/", ["d"])]
    assert tuple(scores.acceptance(tried).first()) == (3, 6, 2, pytest.approx(2 / 3))
    assert tuple(scores.acceptance(tried.limit(0)).first()) == (0, 0, 0, 0.0)


def test_reports(spark):
    df = spark.createDataFrame([(i, "i" * 300, "r", "qa", True) for i in range(60)], "_rid long, instruction string, response string, type string, has_code boolean")
    rows = scores.answer_samples(df).collect()
    assert len(rows) == 50 and len(rows[0].instruction) == 200
    parsed = readers.parse_records(spark.createDataFrame([('{"a": 1}',), ("{",), (None,)], "j string"), "j", "a int").collect()
    assert [r.record.a if r.record else None for r in parsed] == [1, None, None]
    problems = spark.createDataFrame([([],), (None,), ([("1", "2")],)], "examples array<struct<input:string,output:string>>")
    assert [r.skipped for r in scores.mark_skipped(problems).collect()] == [True, True, False]
    names = spark.createDataFrame([("qwen2.5-coder-7b",), ("own",)], "m string").select(text.alias("m", readers.MODEL_NAMES).alias("m")).collect()
    assert [r.m for r in names] == ["Qwen/Qwen2.5-Coder-7B", "own"]


def test_index_outlives_a_run(spark, tmp_path):
    """Runs in turn keep what one run over all keeps; a run that is repeated adds nothing; rows without shingles stay."""
    words = lambda i: " ".join(f"w{(i * 7 + k) % 90}" for k in range(60))
    rows = [(i, words(i // 3) + (f" x{i}" if i % 3 == 1 else "")) for i in range(60)] + [(60, ""), (61, None), (62, "")]
    df = spark.createDataFrame(rows, "_rid long, problem string")
    whole = {r._rid for r in dedup.dedup_near(df).collect()}
    got, path = set(), str(tmp_path / "index")
    for run in range(4):
        index = near_index.NearIndex(spark, path, 4)
        part = df.where(f"_rid div 16 = {run}")
        kept = {r._rid for r in index.add(part, str(run)).collect()}
        assert {r._rid for r in index.add(part, str(run)).collect()} == kept
        hits = {r._rid for r in index.hits(part).collect()}
        assert {r._rid for r in part.collect()} - hits <= kept
        got |= kept
        assert index.rows().select("id").distinct().count() == len(got)
        index.close()
    assert got == whole and {60, 61, 62} <= got < {r[0] for r in rows}
    index = near_index.NearIndex(spark, path, 4)
    plan = index._hashes(dedup.signatures(df, "_rid", "problem").withColumnRenamed("_rid", "id")).hint("merge").join(index.rows().select("h"), "h", "left_semi")._jdf.queryExecution().executedPlan().toString()
    assert "Bucketed: true" in plan
    index.close()


def test_length_groups(spark):
    rows = [(i, i * 37 % 101 if i % 10 else None) for i in range(100)]
    df = spark.createDataFrame(rows, "_rid long, n int").repartition(3)
    got = tokens.length_groups(df, "n", 4, 5)
    by = sorted((r.mega, r.place, -1 if r.length is None else r.length, r.batch) for r in got.collect())
    assert [m for m, *_ in by] == [i // 20 for i in range(100)] and by[0][2] == max(n or 0 for _, n in rows)
    for m in range(5):
        inside = [x[2] for x in by if x[0] == m]
        assert inside[1:] == sorted(inside[1:], reverse=True) and [x[3] for x in by if x[0] == m] == [m * 5 + i // 4 for i in range(20)]
    padded = sum(r.padding for r in tokens.batch_padding(got).collect())
    drawn = split.ranked(df).withColumn("batch", F.floor(F.col("_rank") / 4)).withColumn("length", F.col("n"))
    assert 3 * padded < sum(r.padding for r in tokens.batch_padding(drawn).collect())
    laid = tokens.in_batches(df, got)
    assert [(r.mega, r.place) for r in laid.collect()] == [(m, p) for m, p, *_ in by]
    assert tokens.length_groups(df.limit(0), "n").isEmpty()


def test_counts_of_nothing(spark):
    """A source without rows: all counts are 0."""
    raw = {"taco": spark.createDataFrame([], "_rid long, question string, solutions string, input_output string, difficulty string, tags string")}
    built = build(raw, Options(method="exact"))
    r = built["meta"].first()
    assert (r.n_preprocessed, r.n_filtered, r.n_deduplicated, r.n_train, r.n_val, r.n_test) == (0, 0, 0, 0, 0, 0) and built["train"].isEmpty()
    built.discard()


def test_options_of_a_configuration():
    assert Options.of({"threshold": "0.5", "seed": "7", "verify": "true", "names": "taco,apps", "text_col": ""}) == Options(threshold=0.5, seed=7, verify=True, names=["taco", "apps"])
    assert Options.of({"names": ["taco"], "clean_val": True, "solutions": 2}) == Options(names=["taco"], clean_val=True, solutions=2)
    for bad in ({"no_such": 1}, {"verify": "perhaps"}, {"seed": "x"}):
        with pytest.raises(ValueError):
            Options.of(bad)


def test_command_line(spark, tmp_path):
    from millrace.__main__ import main

    raw, out = str(tmp_path / "raw"), str(tmp_path / "out")
    rows = [(f"Given an array of {i} numbers and {i * i} queries, print the sum of each range modulo {i + 7}.", '["print(1)"]', "", "easy", "dp") for i in range(40)]
    spark.createDataFrame(rows, "question string, solutions string, input_output string, difficulty string, tags string").write.json(readers.SOURCES["cp"]["taco"].folder(raw))
    readers.write_config({"method": "exact", "test": 0.1, "seed": 3}, str(tmp_path / "c.json"))
    args = [raw, out, "--config", str(tmp_path / "c.json"), "names=taco,apps", "seed=5"]
    assert main(args, spark) is True and main(args, spark) is False
    meta = readers.read_jsonl(spark, f"{out}/meta", "seed int, method string, n_preprocessed long, n_test long").first()
    assert tuple(meta) == (5, "exact", 40, 4)


def test_table_functions(spark):
    """Blocks as the column functions find them; pairs by hand, with parted and unanswered turns."""
    from millrace.functions.tables import register

    register(spark)
    given = ["", None, "x ```py\nA\n``` y ```\nB\n``` z ``` open", "```C++\nint x;\n```", "```été\nq\n```", "a ```\n```b", "```js \n1\n```\n```js\n2\n```"]
    docs = spark.createDataFrame(list(enumerate(given)), "i long, t string")
    docs.createOrReplaceTempView("given_texts")
    got = sorted((r.i, r.place, r.lang, r.code) for r in spark.sql("SELECT d.i, b.* FROM given_texts d, LATERAL code_blocks(d.t) b").collect())
    want = [(r.i, k, b.lang, b.code) for r in docs.select("i", extract.named_blocks("t").alias("b")).collect() for k, b in enumerate(r.b or [], 1)]
    assert got == sorted(want) and got
    turns = [(1, 0, "user", "a"), (1, 1, "assistant", "b"), (1, 2, "assistant", "c"), (1, 3, "user", "d"), (1, 4, "user", None), (1, 5, "system", "s"), (1, 6, "assistant", "e"), (2, 0, "assistant", "f"), (2, 1, "user", "g"), (3, 0, None, "h")]
    spark.createDataFrame(turns, "conv_id long, turn long, role string, text string").repartition(4).createOrReplaceTempView("given_turns")
    pairs = spark.sql("SELECT * FROM turn_pairs(TABLE(given_turns) PARTITION BY conv_id ORDER BY turn)").collect()
    assert sorted(map(tuple, pairs)) == [(1, 1, "a", "b"), (1, 2, "", "e")]


def test_bands_come_in_bounded_frames():
    """A frame of many rows is given back in parts, so that their whole sets are not held at once."""
    pd = __import__("pandas")
    frame = pd.DataFrame({"id": range(1201), "k": ["some key of words", "", "other"] * 400 + ["x"]})
    parts = list(dedup._banded(True)([frame]))
    assert max(map(len, parts)) <= dedup.A_FRAME and pd.concat(parts)["id"].tolist() == list(range(1201))


def test_common_shingles_are_hashed_once(monkeypatch):
    """However many pairs of words a task has seen, 3-grams that recur cost one digest; bands are those of the definition, at hand or not."""
    import hashlib
    import random
    from types import SimpleNamespace

    import numpy as np
    import pandas as pd

    rng, digests = random.Random(3), []
    words = ["".join(rng.choice("abcdefgh") for _ in range(4)) for _ in range(300)]
    keys = [" ".join(rng.choice(words) for _ in range(40)) for _ in range(120)]
    keys += ["", "a", "ab", "x y", "abc", "\ud800ab c\udfff", "x\x00y z", *("".join(chr(rng.randrange(0x4E00, 0x9FFF)) for _ in range(60)) for _ in range(20))]
    low = lambda x: int.from_bytes(hashlib.md5(x.encode("utf-8", "surrogatepass")).digest()[:4]) & dedup.PRIME
    mix = np.random.default_rng(2).integers(1, 2**62, dedup.ROWS).tolist()

    def plain(key):
        if not (h := [low(x) for x in dedup._shingles(key)]):
            return []
        least = [min((a * x + b) % dedup.PRIME for x in h) for a, b in dedup.permutations()]
        sums = [sum(x * y for x, y in zip(least[i : i + dedup.ROWS], mix)) % 2**64 for i in range(0, len(least), dedup.ROWS)]
        return [x - 2**64 * (x >= 2**63) for x in sums]

    frame, want = pd.DataFrame({"id": range(len(keys)), "k": keys}), list(map(plain, keys))
    common = {x for k in keys[:120] for x in dedup._shingles(k) if len(x) == 3}
    monkeypatch.setattr(dedup, "hashlib", SimpleNamespace(md5=lambda x: digests.append(x) or hashlib.md5(x)))
    for known, stretch in ((1000, 1 << 20), (100, 7), (0, 7)):
        monkeypatch.setattr(dedup, "KNOWN", known)
        monkeypatch.setattr(dedup, "STRETCH", stretch, raising=False)
        digests.clear()
        got = pd.concat(list(dedup._banded(False)([frame.iloc[i : i + 30] for i in range(0, len(frame), 30)])))
        assert got["bands"].tolist() == want
        if known == 1000:
            assert len(common) < known and sum(x.decode("utf-8", "surrogatepass") in common for x in digests) <= len(common)


def test_verified_minhash_stores_no_sets(spark):
    """Bands come with a digest of the set, of fixed size; pairs are compared from their texts, and the rows are those of brute force."""
    import random

    rng, rows = random.Random(5), []
    words = ["".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(400)]
    for _ in range(25):
        base = [rng.choice(words) for _ in range(80)]
        rows.append(" ".join(base))
        for changes in (0, 2, 6, 20):
            rows.append(" ".join(rng.choice(words) if i < changes else w for i, w in enumerate(base)))
    df = spark.createDataFrame([*enumerate(rows), (900, None), (901, ""), (902, "x")], "_rid long, problem string").repartition(5)
    signed = dedup.signatures(df, "_rid", "problem", True)
    assert signed.columns == ["id", "digest", "bands"] and max(len(r.digest) for r in signed.collect()) == 16
    sets = {r.id: dedup._shingles(r.k) for r in dedup.keys(df, "_rid", "problem").collect()}
    alike = lambda a, b: len(a & b) >= 0.85 * len(a | b) and bool(a)
    bands = {(r.lo, r.hi) for r in dedup.band_edges(signed).collect()}
    kept = []
    for i in sorted(sets):
        if not any((j, i) in bands and alike(sets[j], sets[i]) for j in kept):
            kept.append(i)
    got = sorted(r._rid for r in dedup.dedup_near(df, verify=True).collect())
    assert got == kept and 50 < len(got) < len(rows)


def test_exact_join_reads_texts_few_times_and_stores_little(spark):
    """Classes and levels come from one pass; the first shingles are stored as packed columns, some 9 bytes each."""
    import os

    import numpy as np

    rows = spark.createDataFrame([(i, f"some words of number{i % 900} and others{i * 7 % 1000} follow here{i % 13}") for i in range(3000)] + [(5000, "")], "id long, k string").repartition(3)
    classes, levels = dedup.classes_and_levels(rows)
    assert np.array_equal(levels, dedup._levels(rows)) and levels.any()
    assert sorted(map(tuple, classes.collect())) == sorted(map(tuple, dedup.set_classes(rows).collect())) and classes.count() == 3000
    begun = dedup._begun(rows, spark.sparkContext.broadcast(levels), 0.85)
    stored = sum(os.path.getsize(f.removeprefix("file://")) for f in begun.inputFiles())
    assert begun.columns == ["id", "h", "n", "at"] and 0 < stored < 16 * begun.count()
