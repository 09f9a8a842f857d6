"""PII: base patterns, then information-theoretic sanitisation of terms.

Base spans (email, ip, card, phone) come from regular expressions over whole
texts. Each distinct value found is a protected entity, and so is each group
of values that share a part: an email's name and its domain, an ip's first
three numbers, a card's first six digits, a phone's digits but the last seven.
Terms (words that no base span touches) may give an entity away without naming
it: with N documents, n_e holding entity e, n_t holding term t and n_et both,
anywhere in the document, the chance that a document with t holds e is
estimated from the other documents with t, smoothed towards the entity's own:

    p = (n_et - 1 + SMOOTH * n_e / N) / (n_t - 1 + SMOOTH)

and the term's disclosure of e is log2(p * N / n_e) / log2(N / n_e), the share
of the entity's information that the term reveals (towards 1: the term only
occurs with the entity). A single document says nothing: its words go with all
it holds, so a value of one document is protected through its groups. A term
that discloses ``DISCLOSED`` or more of any entity is a span of kind ``term``
wherever it stands, also in documents without the entity. Every document
counts, copies too. ``sanitised`` generalises base spans to their kind and
removes terms. All counts are over the whole corpus; only DataFrame functions
are used.

Positions are code points, ends exclusive. Patterns run on copies of the text
of the same length in which separators inside a number or domain are one mark,
so that no pattern needs a repeated group (which would recurse on very long
matches). Null and empty texts have no spans; repeated rows have the same
spans; null ids are kept; a corpus in which every document holds an entity
discloses nothing about it. Empty tables give no rows; other columns stay in
``sanitised``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm.common import row_key, table, written

DISCLOSED = 0.9
SMOOTH = 0.5  # documents' worth of the entity's own frequency
KINDS = ["email", "ip", "card", "phone"]
_EMAIL = r"(?:(?<![A-Za-z0-9._%+\x01-])|\G)[A-Za-z0-9._%+\x01-]++@[A-Za-z0-9-]++\x01[A-Za-z0-9\x01-]+"
_IP = r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]+"
_CARD = r"[0-9][0-9\x01]+"
_PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
_BREAK = r"[\x20\x09-\x0D]"
_SPANS = "array<struct<start:int,k:int,kind:string,end:int,value:string>>"


def located(text: Column, pattern: str) -> Column:
    """array<struct<at, to, hit>> of a pattern's matches in ``text``: lengths
    of the gaps and of the matches, summed from the left."""
    hits, gaps = F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.split(text, pattern, -1)
    pairs = F.zip_with(F.slice(gaps, 1, F.size(hits)), hits, lambda g, h: F.struct(F.length(g).alias("gap"), h.alias("hit")))
    empty = F.expr("cast(array() as array<struct<at:int,to:int,hit:string>>)")

    def step(acc: Column, x: Column) -> Column:
        at = acc["pos"] + x["gap"]
        to = at + F.length(x["hit"])
        return F.struct(to.alias("pos"), F.concat(acc["out"], F.array(F.struct(at.alias("at"), to.alias("to"), x["hit"].alias("hit")))).alias("out"))

    return F.aggregate(pairs, F.struct(F.lit(0).alias("pos"), empty.alias("out")), step, lambda a: a["out"])


def _luhn(digits: Column) -> Column:
    """Whether a string of 14 to 19 digits passes the check."""
    d = F.transform(F.split(F.reverse(digits), "(?!$)"), lambda c, i: c.cast("int") * (1 + i % 2))
    return F.aggregate(d, F.lit(0), lambda a, x: a + F.when(x > 9, x - 9).otherwise(x)) % 10 == 0


def _ok(k: int, hit: Column) -> Column:
    digits = F.regexp_replace(hit, "[^0-9]", "")
    n = F.length(digits)
    if k == 1:
        return F.forall(F.split(hit, r"\."), lambda p: (F.length(F.regexp_replace(p, "^0+", "")) <= 3) & (F.coalesce(F.regexp_replace(p, "^0+", "").try_cast("int"), F.lit(0)) <= 255))
    if k == 2:
        return n.between(14, 19) & F.when(n.between(14, 19), _luhn(digits)).otherwise(False)
    return n.between(10, 15) if k == 3 else F.lit(True)


def base_spans(docs: DataFrame) -> DataFrame:
    """``docs`` with t (the text, null as empty) and spans, sorted."""
    none = F.expr("cast(array() as array<struct<at:int,to:int,hit:string>>)")
    t = F.coalesce(F.col("text"), F.lit(""))
    marked = F.translate(F.col("t"), "\x01", "\x02")
    rows = docs.withColumn("t", t).withColumn(
        "found",
        F.struct(
            F.when(F.col("t").contains("@"), located(F.regexp_replace(marked, r"(?<=[A-Za-z0-9-])\.(?=[A-Za-z0-9-])", "\x01"), _EMAIL)).otherwise(none).alias("email"),
            F.when(F.col("t").rlike(r"[0-9]\.[0-9]"), located(F.col("t"), _IP)).otherwise(none).alias("ip"),
            F.when(F.col("t").rlike(r"[0-9][\x20-]?[0-9]"), located(F.regexp_replace(marked, r"(?<=[0-9])[\x20-](?=[0-9])", "\x01"), _CARD)).otherwise(none).alias("card"),
            F.when(F.col("t").rlike(r"\+[0-9]"), located(F.col("t"), _PHONE)).otherwise(none).alias("phone"),
        ),
    )

    def of(k: int) -> Column:
        kept = F.filter(F.col(f"found.{KINDS[k]}"), lambda s: _ok(k, s["hit"]))
        return F.transform(kept, lambda s: F.struct(s["at"].alias("start"), F.lit(k).alias("k"), F.lit(KINDS[k]).alias("kind"), s["to"].alias("end"), F.substring(F.col("t"), s["at"] + 1, s["to"] - s["at"]).alias("value")))

    return rows.withColumn("spans", F.array_sort(F.concat(*map(of, range(len(KINDS))))).cast(_SPANS)).drop("found")


def _entities(s: Column) -> Column:
    """array<struct<kind, value>>: a span's value and the groups it is of."""
    name = lambda kind, value: F.struct(F.lit(kind).alias("kind"), value.alias("value"))
    low, digits = F.lower(s["value"]), F.regexp_replace(s["value"], "[^0-9]", "")
    email = F.array(name("email", low), name("name", F.substring_index(low, "@", 1)), name("domain", F.substring_index(low, "@", -1)))
    ip = F.array(name("ip", low), name("net", F.substring_index(low, ".", 3)))
    card = F.array(name("card", digits), name("issuer", F.substring(digits, 1, 6)))
    phone = F.array(name("phone", digits), name("area", F.substring(digits, F.lit(1), F.length(digits) - 7)))
    return F.when(s["k"] == 0, email).when(s["k"] == 1, ip).when(s["k"] == 2, card).otherwise(phone)


def _plain(text: Column) -> Column:
    return F.translate(F.coalesce(text, F.lit("")), "\x01", "\x02")


def _words() -> Column:
    """The words of t between single breaks (some empty), in order; what base
    spans touch holds marks, at the same length."""
    t = _plain(F.col("t"))

    def step(acc: Column, s: Column) -> Column:
        at = F.greatest(s["start"], acc["pos"])
        out = F.concat(acc["out"], F.substring(t, acc["pos"] + 1, at - acc["pos"]), F.repeat(F.lit("\x01"), s["end"] - at))
        return F.when(s["end"] > acc["pos"], F.struct(s["end"].alias("pos"), out.alias("out"))).otherwise(acc)

    blank = F.aggregate("spans", F.struct(F.lit(0).alias("pos"), F.lit("").alias("out")), step, lambda a: F.concat(a["out"], F.substring(t, a["pos"] + 1, F.length(t))))
    return F.split(F.when(F.size("spans") > 0, blank).otherwise(t), _BREAK, -1)


def _told(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def find_private(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, key (of the text), base, all: sorted spans."""
    key = F.md5(F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("key")
    own = F.filter(F.array_distinct(_words()), lambda w: (w != "") & ~w.contains("\x01"))
    rows = base_spans(docs.select("doc_id", "text", key))
    base = written(rows.select("doc_id", "key", "spans", F.when(F.size("spans") > 0, own).alias("words")), "pii-base")
    n = base.count()
    private = base.where("size(spans) > 0")
    held = private.select("key", F.explode(F.array_distinct(F.flatten(F.transform("spans", _entities)))).alias("x")).groupBy("key", "x.kind", "x.value").agg(F.count("*").alias("c"))
    # What fewer than two documents hold has p = n_e / N or less, and discloses nothing.
    entities = held.groupBy("kind", "value").agg(F.sum("c").alias("n_e")).where("n_e > 1")
    every = docs.select(key, F.explode(F.array_distinct(F.split(_plain(F.col("text")), _BREAK))).alias("term")).where("term <> ''")
    words = every.groupBy("term").agg(F.count("*").alias("n_t")).where("n_t > 1")
    near = private.select("key", F.explode("words").alias("term")).distinct().join(words, "term")
    both = near.join(held.join(entities, ["kind", "value"]), "key").groupBy("kind", "value", "term").agg(F.sum("c").alias("n_et"), F.first("n_t").alias("n_t"), F.first("n_e").alias("n_e"))
    bits = F.log2(F.lit(float(n)) / F.col("n_e"))
    p = (F.col("n_et") - 1 + SMOOTH * F.col("n_e") / float(n)) / (F.col("n_t") - 1 + SMOOTH)
    share = F.when(bits > 0, 1 + F.log2(p) / bits).otherwise(0.0)
    disclosing = written(both.where(share >= DISCLOSED).select("term").distinct(), "pii-terms")
    # First by a short hash, whose table stays small enough to send: only texts with hits move.
    hits = written(every.join(disclosing, "term").groupBy("key").agg(F.collect_set("term").alias("hits")), "pii-hits")
    short = written(hits.select(F.xxhash64("key").alias("short")).distinct(), "pii-short")
    some = docs.select("text", key).withColumn("short", F.xxhash64("key")).join(short, "short", "left_semi").drop("short")
    # Equal texts have equal spans: each text that holds such a term is looked through once.
    texts = base_spans(some.join(hits, "key").dropDuplicates(["key"])).withColumn("words", _words())
    found = F.filter(F.transform("words", lambda w, i: F.struct(w.alias("w"), i.alias("i"))), lambda x: F.array_contains(F.col("hits"), x["w"]))
    start = lambda x: F.when(x["i"] > 0, F.length(F.array_join(F.slice("words", F.lit(1), x["i"]), " ")) + 1).otherwise(0)
    placed = F.transform(F.transform(found, lambda x: F.struct(start(x).alias("at"), F.length(x["w"]).alias("n"))), lambda x: F.struct(x["at"].alias("start"), F.lit(len(KINDS)).alias("k"), F.lit("term").alias("kind"), (x["at"] + x["n"]).alias("end"), F.lit("").alias("value")))
    terms = texts.select("key", placed.cast(_SPANS).alias("terms"))
    spans = F.array_sort(F.concat("spans", F.coalesce("terms", F.expr(f"cast(array() as {_SPANS})"))))
    return base.join(terms, "key", "left").select("doc_id", "key", F.col("spans").alias("base"), spans.alias("all"))


def sanitised(docs: DataFrame) -> DataFrame:
    """``docs`` with base spans generalised to ``[KIND]`` and terms removed
    (of spans that overlap, the earlier one stands)."""
    spans = find_private(docs).where("size(all) > 0").select(row_key().alias("_id"), F.col("key").alias("_key"), F.col("all").alias("_all")).dropDuplicates(["_id", "_key"])
    text = F.col("text")

    def step(acc: Column, s: Column) -> Column:
        skip = s["start"] < acc["pos"]
        name = F.when(s["kind"] == "term", "").otherwise(F.concat(F.lit("["), F.upper(s["kind"]), F.lit("]")))
        return F.struct(F.when(skip, acc["pos"]).otherwise(s["end"]).alias("pos"), F.when(skip, acc["out"]).otherwise(F.concat(acc["out"], F.substring(text, acc["pos"] + 1, s["start"] - acc["pos"]), name)).alias("out"))

    new = F.aggregate("_all", F.struct(F.lit(0).alias("pos"), F.lit("").alias("out")), step, lambda a: F.concat(a["out"], F.substring(text, a["pos"] + 1, F.length(text))))
    rows = docs.withColumns({"_id": row_key(), "_key": F.md5(F.coalesce(text, F.lit("")).cast("binary"))}).join(spans, ["_id", "_key"], "left")
    return rows.withColumn("text", F.when(F.col("_all").isNull(), text).otherwise(new)).select(*docs.columns)


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_private(table(spark, sf_dir, "documents"))

    def of(k: int) -> Column:
        return F.size(F.filter("base", lambda s: s["k"] == k)).cast("long").alias(f"n_{KINDS[k]}")

    count = map(of, range(len(KINDS)))
    return found.select("doc_id", *count, F.sha2(_told(F.col("base")), 256).alias("base_sha256"), _told(F.col("all")).alias("spans"))
