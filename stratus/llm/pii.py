r"""Personal data: known kinds, and terms that give away what they protect.

Known kinds: e-mail addresses, IP addresses, payment card numbers, phone numbers.

Information-theoretic sanitisation: the values of the known kinds are the
protected entities.  A term (a word of three or more code points, not all digits,
lower-cased) stands near an entity where at most ``REACH`` words lie between.
Over all documents, with p(c) the share of documents that hold entity c and
p(c|t) the share of the documents with term t in which c stands near it, the
term's pointwise mutual information with c, relative to what c itself tells
(-log p(c)), is its disclosure 1 - log p(c|t) / log p(c): 0 for a term that says
nothing about c, 1 for one that is never seen without it.  A term that stands
near one entity in at least ``MIN_CONTEXTS`` different surroundings (copies of a
passage are one) and discloses it by ``DISCLOSED`` or more is taken out wherever
it occurs: *generalised* to its first ``PREFIX`` letters where the words with
these letters together disclose no entity that much, *removed* otherwise.

Every row is a document; terms, prefixes and entities are counted by 64-bit
hashes.  A term that is nowhere a word of its own is none.  Where spans of several kinds
overlap, the statistics take the entity of the first in the order e-mail, phone,
card, IP.

Positions are code points, end exclusive.  ``spans`` lists all spans as
kind:start:end by start, then kind (email, ip, card, phone, general, remove); a
term that overlaps a known span adds nothing.

Defined cases: a null text counts as empty; a text without personal data has
zero counts, the hash of the empty string and no known spans; repeated rows are
returned one by one, alike; a null id is carried; an entity in every document is
not protected; an empty table gives no rows; other columns are ignored, whatever
their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratus.llm.common import small_side, written
from stratus.llm.spans import LISTED, in_order, let, listed, outside, replaced, spans_of

# A match starts where a run of its characters starts or the last match ended,
# and never gives back what it took: the same matches as without, in one pass.
EMAIL = r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
KINDS = ["email", "ip", "card", "phone"]

PART = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]?[0-9])"
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: Words between a term and an entity; different surroundings that count as
#: evidence; disclosure from which a term goes; letters a general form keeps.
REACH, MIN_CONTEXTS, DISCLOSED, PREFIX = 10, 3, 0.9, 3
#: As many terms (a long and a flag each) are broadcast; more are joined by shuffle.
BROADCAST_ROWS = 1_000_000
_MARK = "\x01"


def _digits(found: Column) -> Column:
    return F.regexp_replace(found, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Whether the check digit of 12 to 19 digits is right."""
    values = F.transform(F.regexp_extract_all(F.reverse(digits), F.lit("[0-9]"), F.lit(0)), lambda d, k: let(
        d.cast("int") * (1 + k % 2), lambda v: F.when(v > 9, v - 9).otherwise(v)))
    return F.when(F.length(digits).between(12, 19), F.aggregate(values, F.lit(0), lambda a, v: a + v) % 10 == 0).otherwise(False)


def _valid(kind: str, found: Column) -> Column:
    if kind == "ip":
        return F.regexp_like(found, F.lit(rf"^{PART}\.{PART}\.{PART}\.{PART}$"))
    if kind == "card":
        return _luhn(_digits(found))
    if kind == "phone":
        return F.length(_digits(found)).between(9, 15)
    return F.lit(True)


PATTERNS = {"email": EMAIL, "ip": IP, "card": CARD, "phone": PHONE}


def known_spans(text: Column) -> dict[str, Column]:
    """The spans of every known kind, in order."""
    guards = {"email": F.contains(text, F.lit("@")), "phone": F.contains(text, F.lit("+"))}
    return {kind: F.filter(spans_of(text, PATTERNS[kind], kind, k, guards.get(kind)), lambda s: _valid(kind, s["found"]))
            for k, kind in enumerate(KINDS)}


def _marked(kind: str, found: Column) -> Column:
    value = F.lower(found) if kind == "email" else found if kind == "ip" else _digits(found)
    return F.concat(F.lit(f" {_MARK}{kind[0]}"), F.translate(F.md5(value), "0123456789", "ghijklmnop"), F.lit(" "))


def _tagged(docs: DataFrame) -> DataFrame:
    """``docs`` with the entities in column tagged put as a mark and 33 letters."""
    for kind in ("email", "phone", "card", "ip"):
        pattern, t = PATTERNS[kind], F.col("tagged")

        hits = F.transform(F.regexp_extract_all(t, F.lit(pattern), F.lit(0)),
                           lambda h: F.when(_valid(kind, h), _marked(kind, h)).otherwise(h))
        parts = F.zip_with(F.split(t, pattern, -1), hits, lambda g, h: F.concat(g, F.coalesce(h, F.lit(""))))
        docs = docs.withColumn("tagged", F.when(F.regexp_like(t, F.lit(pattern)), F.array_join(parts, "")).otherwise(t))
    return docs


def _term(word: Column) -> Column:
    return F.xxhash64(F.lower(word))


def _class(word: Column) -> Column:
    return F.xxhash64(F.lit("class"), F.substring(F.lower(word), 1, PREFIX))


def _is_term(word: Column) -> Column:
    return (F.length(word) >= 3) & F.regexp_like(word, F.lit("[^0-9]"))


def _windows(tagged: Column) -> Column:
    """Per entity occurrence: the entity, its surroundings' hash and the terms in them."""
    def near(words: Column) -> Column:
        at = F.filter(F.transform(words, lambda w, k: F.struct(k.alias("at"), w.alias("word"))), lambda e: F.startswith(e["word"], F.lit(_MARK)))
        around = F.transform(at, lambda e: F.struct(
            F.xxhash64(e["word"]).alias("entity"),
            F.filter(F.slice(words, F.greatest(F.lit(1), e["at"] + 1 - REACH), F.least(F.lit(REACH), e["at"]) + REACH + 1),
                     lambda w: ~F.startswith(w, F.lit(_MARK)) & _is_term(w)).alias("words")))
        return F.transform(around, lambda e: F.struct(
            e["entity"].alias("entity"), F.xxhash64(e["words"]).alias("context"),
            F.array_distinct(F.transform(e["words"], lambda w: F.struct(_term(w).alias("term"), _class(w).alias("class")))).alias("terms")))

    return let(F.regexp_extract_all(tagged, F.lit(rf"{_MARK}[a-z]+|{TERM}"), F.lit(0)), near)


_WINDOW = "array<struct<entity:long,context:long,terms:array<struct<term:long,class:long>>>>"


def scan_known(docs: DataFrame) -> DataFrame:
    """row, key, doc_id, counts, the known spans, and the windows of the entities."""
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.xxhash64("doc_id", "text").alias("key"), "doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text"))
    rows = rows.select("row", "key", "doc_id", "text", *[v.alias(k) for k, v in known_spans(F.col("text")).items()])
    some = F.size("email") + F.size("ip") + F.size("card") + F.size("phone") > 0
    rows = _tagged(rows.withColumn("tagged", F.when(some, F.translate("text", _MARK, " "))))
    return rows.select("row", "key", "doc_id", *[F.size(k).cast("long").alias(f"n_{k}") for k in KINDS],
                       in_order(F.concat(*KINDS)).alias("known"),
                       F.coalesce(_windows(F.col("tagged")), F.array().cast(_WINDOW)).alias("windows"))


def _words(text: Column) -> Column:
    return F.filter(F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(TERM), F.lit(0)), _is_term)


def disclosing_terms(found: DataFrame, docs: DataFrame) -> DataFrame:
    """(term, general): hashes of the terms that disclose an entity, and whether
    their general form discloses none."""
    near = found.where(F.size("windows") > 0).select("row", F.inline("windows"))
    pairs = near.select("row", "entity", "context", F.inline("terms"))
    support = written(pairs.groupBy("entity", "term", "class").agg(
        F.count_distinct("row").alias("both"), F.count_distinct("context").alias("contexts")).where(F.col("contexts") >= MIN_CONTEXTS), "support")
    wanted = support.select(F.explode(F.array("term", "class")).alias("word")).distinct()
    many = found.count()
    # All words are counted before any is picked: what a task sends is bounded by its vocabulary.
    hashed = docs.select(_words(F.col("text")).alias("words")).select(F.explode(F.array_distinct(F.concat(
        F.transform("words", _term), F.transform("words", _class)))).alias("word"))
    held = written(hashed.groupBy("word").agg(F.count(F.lit(1)).alias("docs")).join(small_side(wanted, BROADCAST_ROWS), "word"), "held")
    of_entity = near.groupBy("entity").agg(F.count_distinct("row").alias("of"))
    classes = (pairs.join(support.select("entity", "class").distinct(), ["entity", "class"])
               .groupBy("entity", "class").agg(F.count_distinct("row").alias("class_both")))
    told = F.log(F.lit(float(many or 1)) / F.col("of"))

    def disclosure(both: str, docs_with: str) -> Column:
        return 1 + F.log(F.col(both) / F.col(docs_with)) / told

    scored = (support.join(of_entity, "entity").where(F.col("of") < many).join(classes, ["entity", "class"])
              .join(held.select(F.col("word").alias("term"), F.col("docs").alias("term_docs")), "term")
              .join(held.select(F.col("word").alias("class"), F.col("docs").alias("class_docs")), "class")
              .withColumn("by_class", disclosure("class_both", "class_docs")))
    return (scored.where(disclosure("both", "term_docs") >= DISCLOSED).groupBy("term")
            .agg((F.max("by_class") < DISCLOSED).alias("general")))


def _marks(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """(key, marks): where the terms occur.  Which documents hold any is found
    first; only in these the words are placed."""
    terms = small_side(terms, BROADCAST_ROWS)
    keyed = docs.select(F.xxhash64("doc_id", "text").alias("key"), "text")
    having = written(keyed.select("key", F.explode(F.array_distinct(F.transform(_words(F.col("text")), _term))).alias("term"))
                     .join(terms, "term", "leftsemi").select("key").distinct(), "having")
    words = F.filter(spans_of(F.col("text"), TERM, "", 0), lambda s: _is_term(s["found"]))
    placed = keyed.join(small_side(having, BROADCAST_ROWS), "key", "leftsemi").select("key", F.inline(F.transform(words, lambda s: F.struct(
        s["start"].alias("start"), s["end"].alias("end"), _term(s["found"]).alias("term")))))
    held = placed.join(terms, "term").select("key", F.struct(
        "start", F.when(F.col("general"), 4).otherwise(5).alias("rank"), "end",
        F.when(F.col("general"), "general").otherwise("remove").alias("kind")).alias("mark"))
    return held.groupBy("key").agg(F.array_sort(F.collect_set("mark")).alias("marks"))


def personal_spans(docs: DataFrame) -> DataFrame:
    """key, doc_id, n_email, n_ip, n_card, n_phone, known and marks (arrays of
    spans in order), one row per row of ``docs``."""
    found = written(scan_known(docs), "found")
    terms = written(disclosing_terms(found, docs), "terms")
    rows = found.drop("row", "windows")
    nothing = F.array().cast(LISTED)
    if terms.isEmpty():
        return rows.withColumn("marks", nothing)
    # Repeated rows are joined as one.
    once = rows.groupBy(*rows.columns).count().join(_marks(docs, terms), "key", "left")
    return (once.withColumn("marks", outside(F.coalesce("marks", nothing), F.col("known")))
            .withColumn("again", F.explode(F.sequence(F.lit(1), F.col("count").cast("int")))).select(*rows.columns, "marks"))


def find_personal_data(docs: DataFrame) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_terms."""
    rows = personal_spans(docs)
    return rows.select("doc_id", *[f"n_{k}" for k in KINDS], F.sha2(listed(F.col("known")), 256).alias("base_sha256"),
                       listed(F.array_sort(F.concat("known", "marks"))).alias("spans"), F.size("marks").cast("long").alias("n_terms"))


def sanitised(docs: DataFrame) -> DataFrame:
    """doc_id and the text, with known spans put as their kind in brackets,
    removed terms as ``[TERM]`` and generalised ones as their first letters and
    ``*``.  A null text stays null; repeated rows are returned once."""
    spans = personal_spans(docs).select("key", F.array_sort(F.concat("known", "marks")).alias("spans")).dropDuplicates(["key"])

    def label(s: Column, cut) -> Column:
        return (F.when(s["kind"] == "general", F.concat(cut(s["start"], s["start"] + PREFIX), F.lit("*")))
                .when(s["kind"] == "remove", "[TERM]").otherwise(F.concat(F.lit("["), F.upper(s["kind"]), F.lit("]"))))

    rows = docs.select("doc_id", "text", F.xxhash64("doc_id", "text").alias("key")).dropDuplicates(["key"])
    return rows.join(spans, "key").select("doc_id", replaced(F.col("text"), F.col("spans"), label).alias("text"))
