r"""Secret scan: three known kinds of secrets, and random-looking tokens found
by a battery of randomness tests.

Known kinds: assignments of passwords and keys, access key ids, long hex runs.

Method: every run of 20 or more characters of the Base64 and URL-safe alphabets
is a candidate.  Its encoding is inferred (hex, Base32 or Base64; digits alone
are none), and its characters are tested against uniform draws from that
alphabet: chi-squared of the character counts, runs above and below the middle
of the alphabet, serial correlation at lag one.  A candidate is no secret where
the least of the three p-values, times three, rejects uniform draws.  What is
left must also reject text: under text a character repeats inside a token with
the coincidence rate that is measured over the letters-only candidates of all
documents, which gives chi-squared another mean and spread.  Its p-value is
divided by a weight that grows with the token's length (mean one over all
candidates) and held to the Benjamini-Hochberg bound over all candidates of all
documents.  The bound is found on a grid of 1/50 of a decimal digit, by counts
per grid step, so no task sees more than the grid.

Positions are code points, end exclusive.  ``spans`` lists all spans as
kind:start:end by start, then kind (assign, access, hex, random); a candidate
that overlaps a known span adds nothing.

Defined cases: a null text counts as empty; a text without secrets has zero
counts, the hash of the empty string and an empty ``spans``; repeated rows are
scanned one by one; a null id is carried; an empty table gives no rows; other
columns are ignored, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from stratus.llm.common import written
from stratus.llm.spans import LISTED, in_order, listed, outside, spans_of

ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
#: A whole run is one match, so the least length can stand in the pattern.
ACCESS, HEX = r"AKIA[A-Z0-9]{12,}", r"[0-9a-f]{32,}"
CANDIDATE = r"[A-Za-z0-9+/_-]{20,}"
MIN_VALUE = 8

ALPHABETS = {
    "hex": "0123456789abcdef",
    "base32": "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567",
    "base64": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/",
}
#: Share of false secrets allowed; least p-value under uniform draws; lengths
#: beyond this weigh no more; grid steps to a decimal digit of p.
FALSE_SHARE, RANDOM_P, FULL_LENGTH, GRID = 0.01, 0.001, 64, 50
#: Coincidence rate of text where the documents hold no letters-only candidate.
TEXT_RATE = 0.065

def _upper_tail(z: Column) -> Column:
    """P(Z > z) of a normal variable (logistic form, within 0.0002)."""
    return 1 / (1 + F.exp(F.least(F.lit(300.0), 1.5976 * z + 0.07056 * z * z * z)))


def scan_known(docs: DataFrame) -> DataFrame:
    """doc_id, the known spans in order, their counts, and the candidates."""
    text = F.coalesce(F.col("text"), F.lit(""))
    assign = F.filter(spans_of(text, ASSIGN, "assign", 0),
                      lambda s: F.length(F.regexp_extract(s["found"], "^" + ASSIGN + "$", 2)) >= MIN_VALUE)
    out = docs.select("doc_id", text.alias("text")).select(
        "doc_id", assign.alias("assign"), spans_of(F.col("text"), ACCESS, "access", 1).alias("access"),
        spans_of(F.col("text"), HEX, "hex", 2).alias("hex"), spans_of(F.col("text"), CANDIDATE, "random", 3).alias("near"))
    known = F.concat("assign", "access", "hex")
    return out.select(
        "doc_id", *[F.size(k).cast("long").alias(f"n_{k}") for k in ("assign", "access", "hex")],
        in_order(known).alias("known"), outside(F.col("near"), known).alias("near"))


def _tests(token: Column) -> Column:
    """Struct of the inferred encoding's size and the test figures of a token."""
    lower, plain = F.lower(token), F.translate(token, "-_", "+/")
    is_hex = F.regexp_like(token, F.lit("^([0-9a-f]+|[0-9A-F]+)$"))
    is_32 = F.regexp_like(token, F.lit("^[A-Z2-7]+$"))
    size = F.when(is_hex, 16).when(is_32, 32).otherwise(64)
    chars = F.split(F.when(is_hex, lower).when(is_32, token).otherwise(plain), "")
    alphabet = (F.when(is_hex, F.lit(ALPHABETS["hex"])).when(is_32, F.lit(ALPHABETS["base32"]))
                .otherwise(F.lit(ALPHABETS["base64"])))
    codes = F.transform(F.filter(chars, lambda c: c != ""), lambda c: (F.instr(alphabet, c) - 1).cast("double"))
    n = F.length(token).cast("double")

    def total(x: Column) -> Column:
        return F.aggregate(x, F.lit(0.0), lambda a, v: a + v)

    half = F.transform(codes, lambda v: F.when(v >= size / 2, 1.0).otherwise(0.0))
    pairs = F.zip_with(F.slice(codes, 1, F.size(codes) - 1), F.slice(codes, 2, F.size(codes) - 1),
                       lambda a, b: F.struct(a.alias("a"), b.alias("b")))
    changes = F.zip_with(F.slice(half, 1, F.size(half) - 1), F.slice(half, 2, F.size(half) - 1), lambda a, b: F.abs(a - b))
    squares = total(F.transform(F.array_distinct(codes), lambda v: F.pow(F.size(F.filter(codes, lambda w: w == v)).cast("double"), 2)))
    return F.struct(size.cast("double").alias("size"), n.alias("n"), squares.alias("squares"), total(half).alias("high"),
                    (total(changes) + 1).alias("runs"), total(codes).alias("sum"),
                    total(F.transform(codes, lambda v: v * v)).alias("sum2"),
                    total(F.transform(pairs, lambda p: p["a"] * p["b"])).alias("lag"),
                    F.element_at(codes, 1).alias("head"), F.element_at(codes, -1).alias("tail"),
                    F.regexp_like(token, F.lit("^[A-Za-z]+$")).alias("letters"))


def _uniform_p(t) -> Column:
    """Bonferroni p-value of the three tests under uniform draws."""
    n, size = t["n"], t["size"]
    chi = (size / n * t["squares"] - n - (size - 1)) / F.sqrt(2 * (size - 1) * (n - 1) / n)
    up, down = t["high"], n - t["high"]
    mean = 2 * up * down / n + 1
    runs = F.when((up > 0) & (down > 0), (t["runs"] - mean) / F.sqrt(F.greatest(
        F.lit(1e-9), (mean - 1) * (mean - 2) / (n - 1)))).otherwise(F.lit(9.0))
    centre = t["sum"] / n
    variance = t["sum2"] - n * centre * centre
    covariance = t["lag"] - centre * (2 * t["sum"] - t["head"] - t["tail"]) + (n - 1) * centre * centre
    serial = F.when(variance > 0, covariance / variance * F.sqrt(n) + 1 / F.sqrt(n)).otherwise(F.lit(9.0))
    return F.least(F.lit(1.0), 3 * F.least(_upper_tail(chi), 2 * _upper_tail(F.abs(runs)), 2 * _upper_tail(F.abs(serial))))


def _text_p(t, rate: float) -> Column:
    """P-value of so even a chi-squared under text."""
    n, size = t["n"], t["size"]
    excess = F.greatest(F.lit(rate), 2 / size) * size - 1
    mean = (size - 1) + (n - 1) * excess
    spread = F.sqrt(2 * (size - 1) + 4 * n * excess)
    return _upper_tail((mean - (size / n * t["squares"] - n)) / spread)


def scan_secrets(docs: DataFrame) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_random."""
    found = written(scan_known(docs), "found")
    tokens = (found.select(F.explode("near").alias("near")).groupBy(F.col("near.found").alias("token"))
              .agg(F.count(F.lit(1)).alias("times")).where(~F.regexp_like("token", F.lit("^[0-9]+$"))))
    tested = written(tokens.select("token", "times", _tests(F.col("token")).alias("t")), "tested")
    letters = F.col("t.letters")
    whole = tested.agg(
        F.sum(F.when(letters, (F.col("t.squares") - F.col("t.n")) * F.col("times"))).alias("same"),
        F.sum(F.when(letters, F.col("t.n") * (F.col("t.n") - 1) * F.col("times"))).alias("pairs"),
        (F.sum(F.least(F.col("t.n"), F.lit(FULL_LENGTH)) * F.col("times")) / F.sum("times")).alias("length")).first()
    rate = whole["same"] / whole["pairs"] if whole["pairs"] else TEXT_RATE
    weight = F.least(F.col("t.n"), F.lit(FULL_LENGTH)) / F.lit(whole["length"] or 1.0)
    scored = tested.select("token", "times", _uniform_p(F.col("t")).alias("uniform"), F.ceil(
        GRID * F.log10(F.greatest(F.lit(1e-300), _text_p(F.col("t"), rate) / weight))).cast("int").alias("step"))
    scored = scored.where(F.col("uniform") >= RANDOM_P)
    # Benjamini-Hochberg on the grid: the highest step with p <= share * found / candidates.
    many = tested.agg(F.sum("times")).first()[0] or 1
    steps = scored.groupBy("step").agg(F.sum("times").alias("times"))
    steps = steps.withColumn("found", F.sum("times").over(Window.orderBy("step")))
    bound = steps.where(F.pow(F.lit(10.0), F.col("step") / GRID) <= FALSE_SHARE * F.col("found") / many).agg(F.max("step")).first()[0]
    secret = scored.where(F.col("step") <= (-10 ** 6 if bound is None else bound)).select("token")
    secret = written(secret, "secret")
    named = (found.select("doc_id", "n_assign", "n_access", "n_hex", F.xxhash64("known", "near").alias("same"), F.explode("near").alias("near"))
             .join(secret, F.col("near.found") == F.col("token"))
             .groupBy(F.col("doc_id").alias("id"), "same").agg(F.collect_set("near").alias("random")))
    rows = found.withColumn("same", F.xxhash64("known", "near"))
    rows = (rows.join(named.withColumnRenamed("same", "as"), F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("same") == F.col("as")), "left")
            .withColumn("random", F.coalesce(in_order(F.col("random")), F.array().cast(LISTED))))
    return rows.select("doc_id", "n_assign", "n_access", "n_hex", F.sha2(listed(F.col("known")), 256).alias("base_sha256"),
                       listed(F.array_sort(F.concat("known", "random"))).alias("spans"),
                       F.size("random").cast("long").alias("n_random"))
