"""Personal data by patterns and information-theoretic sanitisation, in DataFrame operations only.

Base spans are matches of four patterns. Beyond them, co-occurrence over the whole corpus tells how strongly a term
gives a protected entity away: with n(e), n(t), n(e, t) the numbers of documents with the entity, with the term, and
with both, of N, the term discloses the share PMI(e, t) / IC(e) of what the entity tells,
PMI = log(n(e, t) N / (n(e) n(t))) and IC = -log(n(e) / N). Terms at or over a threshold become spans in the documents
that have the entity, to be generalised or removed. Entities are single values and what several have in common: the
domain of an address, the network of an IP, the issuer of a card, the area of a number. An estimate needs ``min_texts``
different texts behind it; they are counted by hash, in 64 classes, so that they can be added up before the shuffle.

The patterns below are the given ones, rewritten so that Java's engine neither recurses nor backtracks: groups repeat
possessively, and a match starts where a run does or where the last match ended.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, row_key, small, text_of

KINDS = ("email", "ip", "card", "phone")
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9]){12,}+",  # shorter runs can't be cards
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
TERM = r"[\p{L}\p{N}]{3,}"
SPAN = "array<struct<start:int,end:int,value:string>>"


def _found(text: Column, pattern: str, chunk: int = 512) -> Column:
    """Spans (start, end, value) of all matches: what lies between matches, and the matches, give the offsets.

    Arrays grow a chunk of matches at a time, so that a text of many matches isn't copied once for each.
    """
    given = F.lit(pattern)
    between = F.transform(F.split(text, given, -1), F.length)
    both = F.zip_with(between, F.regexp_extract_all(text, given, F.lit(0)), lambda gap, m: F.struct(gap.alias("gap"), m.alias("m")))
    none = F.array().cast(SPAN)

    def step(so_far: Column, x: Column) -> Column:
        start = so_far["at"] + x["gap"]
        end = start + F.length(x["m"])
        more = F.concat(so_far["out"], F.array(F.struct(start.alias("start"), end.alias("end"), x["m"].alias("value"))))
        return F.when(x["m"].isNull(), so_far).otherwise(F.struct(end.alias("at"), more.alias("out")))

    def chunks(all_: Column) -> Column:
        def take(so_far: Column, first: Column) -> Column:
            part = F.aggregate(F.slice(all_, first, F.lit(chunk)), F.struct(so_far["at"].alias("at"), none.alias("out")), step)
            return F.struct(part["at"].alias("at"), F.concat(so_far["out"], part["out"]).alias("out"))

        begin = F.struct(F.lit(0).alias("at"), none.alias("out"))
        return F.aggregate(F.sequence(F.lit(1), F.greatest(F.size(all_), F.lit(1)), F.lit(chunk)), begin, take, lambda x: x["out"])

    # One evaluation of the array for all of its chunks.
    return F.element_at(F.transform(F.array(both), chunks), 1)


def _luhn(digits: Column) -> Column:
    """Whether the check digit is right: from the right, every second digit doubled and its digits added."""
    n = F.length(digits)

    def add(total: Column, i: Column) -> Column:
        d = F.substring(digits, n - i, F.lit(1)).cast("int")
        twice = d * 2
        return total + F.when(i % 2 == 0, d).otherwise(twice - F.when(twice > 9, 9).otherwise(0))

    return F.aggregate(F.sequence(F.lit(0), n - 1), F.lit(0), add) % 10 == 0


def _valid(kind: str, m: Column) -> Column:
    if kind == "ip":
        part = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
        return m.rlike(rf"^{part}\.{part}\.{part}\.{part}$")
    if kind == "card":
        digits = F.regexp_replace(m, "[ -]", "")
        return F.when(F.length(digits).between(13, 19), _luhn(digits)).otherwise(F.lit(False))
    if kind == "phone":
        return F.length(F.regexp_replace(m, "[^0-9]", "")).between(9, 15)
    return F.lit(True)


def base_spans(text: Column, kind: str) -> Column:
    """Valid matches of one kind, in order. Texts that can't match are left before any array is made."""
    hint = {"email": F.contains(text, F.lit("@")), "phone": F.contains(text, F.lit("+"))}.get(kind, F.lit(True))
    hits = F.when(hint & text.rlike(PATTERNS[kind]), F.filter(_found(text, PATTERNS[kind]), lambda s: _valid(kind, s["value"])))
    return F.coalesce(hits, F.array().cast(SPAN))


def _joined(kind: str, spans: Column) -> Column:
    return F.transform(spans, lambda s: F.concat(F.lit(f"{kind}:"), s["start"].cast("string"), F.lit(":"), s["end"].cast("string")))


def _entities(kind: str, value: Column) -> list[Column]:
    """Names of an entity, however it is written, and of the class it belongs to."""
    if kind == "email":
        names = {"email": F.lower(value), "domain": F.lower(F.substring_index(value, "@", -1))}
    elif kind == "ip":
        names = {"ip": value, "network": F.substring_index(value, ".", 2)}
    else:
        digits = F.regexp_replace(value, "[^0-9]", "")
        names = {kind: digits, **({"issuer": F.substring(digits, 1, 6)} if kind == "card" else {"area": F.substring(digits, 1, 5)})}
    return [F.concat(F.lit(f"{k}:"), v) for k, v in names.items()]


def _terms(text: Column) -> Column:
    return F.array_distinct(F.transform(F.regexp_extract_all(text, F.lit(TERM), F.lit(0)), F.lower))


def _disclosing(docs: DataFrame, rows: DataFrame, min_texts: int, threshold: float) -> tuple[DataFrame, DataFrame] | None:
    """(entity, term, disclosure) at or over the threshold, and (body, entity, term) of the texts; None if no term has the support.

    Different texts are taken once, with the number of their rows, so that rows and texts are counted by one aggregate.
    """
    texts = rows.where(F.size("entities") > 0).groupBy("body").agg(F.count("*").alias("n"), F.first("entities").alias("entities"), F.first("terms").alias("terms"))
    hits = texts.select("body", "n", "terms", F.explode("entities").alias("entity"))
    strong = hits.groupBy("entity").agg(F.sum("n").alias("n_e"), F.count("*").alias("texts")).where(F.col("texts") >= min_texts).select("entity", "n_e")
    strong = cut(strong)
    if strong.isEmpty():
        return None
    pairs = hits.join(small(strong), "entity").select("entity", "n_e", "body", "n", F.explode("terms").alias("term"))
    able = pairs.groupBy("entity", "n_e", "term").agg(F.sum("n").alias("n_et"), F.count("*").alias("texts")).where(F.col("texts") >= min_texts).drop("texts")
    able = cut(able)
    if able.isEmpty():
        return None
    wanted = able.select("term").distinct()
    words = docs.select(F.explode(_terms(F.col("text"))).alias("term"))
    counts = words.groupBy("term").agg(F.count("*").alias("n_t")).join(wanted, "term", "left_semi")
    n = F.lit(float(rows.count()))
    information = -F.log(F.col("n_e") / n)
    share = F.log(F.col("n_et") * n / (F.col("n_e") * F.col("n_t"))) / information
    # An entity in every document tells nothing and can't be disclosed.
    found = able.join(counts, "term").withColumn("disclosure", F.when(information > 0, share)).where(F.col("disclosure") >= threshold)
    return cut(found.select("entity", "term", "disclosure")), pairs


def disclosing_terms(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", min_texts: int = 5, threshold: float = 0.8) -> DataFrame | None:
    """(entity, term, disclosure) of the terms at or over the threshold; None if no term has the support."""
    base, rows = _spans(docs, id_col, text_col)
    found = _disclosing(base, cut(rows), min_texts, threshold)
    return found and found[0]


def _spans(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """The texts by row key; and by row key the base spans and, of texts that have some, entities and terms."""
    base = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text"), *row_key(id_col, text_col))
    first = base.withColumns({f"_{k}": base_spans(F.col("text"), k) for k in KINDS})

    def names(kind: str, i: int) -> Column:
        return F.transform(f"_{kind}", lambda s: _entities(kind, s["value"])[i])

    named = [names(k, i) for k in KINDS for i in (0, 1)]
    entities = F.array_distinct(F.concat(*named))
    slim = [F.transform(f"_{k}", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"))).alias(f"_{k}") for k in KINDS]
    some = F.greatest(*[F.size(f"_{k}") for k in KINDS]) > 0
    extra = [F.when(some, x).alias(c) for c, x in (("entities", entities), ("terms", _terms(F.col("text"))), ("body", F.xxhash64("text")))]
    return base, first.select("doc_id", "_k", "_sig", *slim, *extra)


def personal_data(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", min_texts: int = 5, threshold: float = 0.8) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_term, _k, _sig.

    spans: kind:start:end (code points, end exclusive), comma-joined, the base kinds in the order of ``KINDS`` and then
    ``term``, each by start. Null and empty texts have none. A term that overlaps a base span is no span of its own.
    Repeated rows stay and each counts as a document; null ids too. Other columns are not read; no rows in, no rows out.
    """
    base, rows = _spans(docs, id_col, text_col)
    rows = cut(rows)
    found = _disclosing(base, rows, min_texts, threshold)
    span = "array<struct<start:int,end:int>>"
    if found is None or found[0].isEmpty():
        rows = rows.withColumn("_term", F.array().cast(span))
    else:
        disclosing, pairs = found
        told = pairs.join(small(disclosing), ["entity", "term"]).select("body", "term").distinct()
        listed = cut(rows.where(F.size("entities") > 0).select("_k", "_sig", "body").distinct().join(small(told), "body").select("_k", "_sig", "term"))
        suspects = base.join(small(listed.select("_k", "_sig").distinct()), ["_k", "_sig"], "left_semi").dropDuplicates(["_k", "_sig"])
        at = suspects.select("_k", "_sig", F.explode(_found(F.col("text"), TERM)).alias("x")).select("_k", "_sig", F.lower("x.value").alias("term"), "x.start", "x.end")
        marks = at.join(small(listed), ["_k", "_sig", "term"]).groupBy("_k", "_sig").agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("_term"))  # of one text
        known = F.concat(*[F.col(f"_{k}") for k in KINDS])
        free = F.filter("_term", lambda t: ~F.exists(known, lambda b: (b["start"] < t["end"]) & (t["start"] < b["end"])))
        rows = rows.drop("terms", "entities").join(marks, ["_k", "_sig"], "left").withColumn("_term", F.coalesce(free, F.array().cast(span)))
    base_list = F.concat(*[_joined(k, F.col(f"_{k}")) for k in KINDS])
    return rows.select(
        "doc_id",
        *[F.size(f"_{k}").cast("long").alias(f"n_{k}") for k in KINDS],
        F.sha2(F.array_join(base_list, ",").cast("binary"), 256).alias("base_sha256"),
        F.array_join(F.concat(base_list, _joined("term", F.col("_term"))), ",").alias("spans"),
        F.size("_term").cast("long").alias("n_term"),
        "_k",
        "_sig",
    )


def sanitise(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", remove: bool = False, **options) -> DataFrame:
    """``docs`` with its spans in ``text_col`` generalised to their kind, as [EMAIL], or removed; null texts stay null.

    Of spans that overlap, the one that starts first is replaced, and what is left of a later one goes with it.
    """
    spans = personal_data(docs, id_col=id_col, text_col=text_col, **options).where("spans <> ''").select("_k", "_sig", F.col("spans").alias("_spans")).dropDuplicates(["_k", "_sig"])
    k, sig = row_key(id_col, text_col)
    joined = docs.withColumns({"_k": k, "_sig": sig}).join(spans, ["_k", "_sig"], "left")
    parts = F.array_sort(
        F.transform(F.split("_spans", ","), lambda s: F.struct(F.split_part(s, F.lit(":"), F.lit(2)).cast("int").alias("start"), F.split_part(s, F.lit(":"), F.lit(3)).cast("int").alias("end"), F.split_part(s, F.lit(":"), F.lit(1)).alias("kind")))
    )
    text = F.col(text_col)

    def step(so_far: Column, s: Column) -> Column:
        label = F.lit("") if remove else F.concat(F.lit("["), F.upper(s["kind"]), F.lit("]"))
        grown = F.concat(so_far["out"], F.substring(text, so_far["at"] + 1, s["start"] - so_far["at"]), label)
        later = F.struct(F.greatest(so_far["at"], s["end"]).alias("at"), so_far["out"].alias("out"))
        return F.when(s["start"] >= so_far["at"], F.struct(s["end"].alias("at"), grown.alias("out"))).otherwise(later)

    begin = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    rebuilt = F.aggregate(parts, begin, step, lambda x: F.concat(x["out"], F.substring(text, x["at"] + 1, F.length(text))))
    return joined.withColumn(text_col, F.when(F.col("_spans").isNull(), text).otherwise(rebuilt)).select(*docs.columns)
