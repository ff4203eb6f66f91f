"""The filter audit against a plain loop over documents and orders."""

import collections
import itertools
import random
import re

import pytest

from stratus.llm import filter_audit

DOCS = "doc_id long, text string, lang string, part int, mask string, n int"
LABELS = "doc_id long, quality int, toxic int, part string"


def plain_audit(docs, labels):
    first = {}
    for d, t, _ in docs:
        if d is not None:
            first[t or ""] = min(d, first.get(t or "", d))
    good = {d for d, q, _ in labels if q == 1 and d is not None}
    toxic = {d for d, _, x in labels if x == 1 and d is not None}
    parts = collections.defaultdict(list)
    for d, t, lang in docs:
        t = t or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        fails = {"A": len(words) < 100, "B": 100 * len(set(words)) < 80 * len(words),
                 "C": 100 * len(re.findall("[A-Z]", t)) > 10 * len(t), "D": bool(re.search("[#$%&*|]", t)),
                 "E": d is not None and d > first[t]}
        parts[lang or ""].append(({k for k in fails if fails[k]}, d in good, d in toxic))
    out, shapley = [], collections.Counter()
    for part, rows in parts.items():
        for order in itertools.permutations("ABCDE"):
            left, gone = list(rows), []
            for step, f in enumerate(order):
                here = [r for r in left if f in r[0]]
                left = [r for r in left if f not in r[0]]
                shapley[part, f] += len(here)
                out.append((part, "".join(order), step + 1, len(left), len(here), sum(f in r[0] for r in gone),
                            sum(r[0] == {f} for r in rows), sum(r[1] for r in here), sum(r[2] for r in here)))
                gone += here
    return collections.Counter((*r, shapley[r[0], r[1][r[2] - 1]]) for r in out)


def corpus(seed):
    rng, rows = random.Random(seed), []
    for k in range(150):
        words = ["w%d" % rng.randrange(rng.choice([20, 5000])) for _ in range(rng.choice([0, 3, 99, 100, 101, 400]))]
        if rng.random() < 0.2:
            words = [w.upper() for w in words]
        if rng.random() < 0.2 and words:
            words[rng.randrange(len(words))] += rng.choice("#$%&*|")
        rows.append((k, rng.choice([" ", "\t", "\n\x0b "]).join(words), rng.choice(["en", "de", None, ""])))
    for k in range(60):
        rows.append((1000 + k, rng.choice(rows)[1], "en"))
    long = " ".join("é%d" % (k % 9000) for k in range(20_000))
    rows += [(k, "copy " * 120, "fr") for k in range(300, 400)] + [(300, "copy " * 120, "fr")] * 3
    rows += [(None, "copy " * 120, "fr"), (None, None, None), (401, None, "fr"), (402, "", "fr"), (403, long, "x"), (404, long + " z", "x"),
             (405, "A" * 11 + "b" * 89, "x"), (406, "A" * 10 + "é" * 90, "x"), (407, "one-word" * 30_000, "x")]
    return rows


def labels(seed):
    rng = random.Random(seed)
    return [(rng.randrange(0, 1100), rng.choice([0, 1, None]), rng.choice([0, 1, None])) for _ in range(500)] + [(None, 1, 1)]


@pytest.mark.parametrize("shard_bytes, piece_bytes", [(8 << 20, 1 << 20), (3_000, 1_000)])
def test_audit(spark, shard_bytes, piece_bytes):
    """Also with rows that stand in many pieces over many shards."""
    docs, marks = corpus(1), labels(2)
    got = filter_audit.audit_filters(spark.createDataFrame([(*r, 1, "x", 2) for r in docs], DOCS),
                                     spark.createDataFrame([(*r, "y") for r in marks], LABELS), shard_bytes, piece_bytes)
    assert got.columns == ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost",
                           "toxic_lost", "shapley"]
    assert collections.Counter(map(tuple, got.collect())) == plain_audit(docs, marks)


def test_audit_of_nothing(spark):
    assert filter_audit.audit_filters(spark.createDataFrame([], DOCS), spark.createDataFrame([], LABELS)).collect() == []
    got = filter_audit.audit_filters(spark.createDataFrame([(1, "a", "en", 1, "x", 2)], DOCS), spark.createDataFrame([], LABELS))
    assert collections.Counter(map(tuple, got.collect())) == plain_audit([(1, "a", "en")], [])


def test_matrix(spark):
    """Shards and dictionary give back the words of every document."""
    docs = [(k, t) for k, (_, t, _) in enumerate(corpus(3)) if t is not None][:80]
    m = filter_audit.DocumentTermMatrix(spark.createDataFrame(docs, "k long, text string").repartition(3), ["k"], "text", 2_000, 700)
    terms = {(r.shard, r.code): (bytes(r.word).decode(), r.term) for r in m.dictionary().collect()}
    assert len({w for w, _ in terms.values()}) == len({t for _, t in terms.values()}) == len(set(terms.values()))
    assert {(r.shard, r.code): r.term for r in m.columns.collect()} == {k: t for k, (_, t) in terms.items()}
    got = collections.defaultdict(collections.Counter)
    for s in m.shards.collect():
        for i, k in enumerate(s.c0):
            for code, n in zip(s.codes[s.start[i]:s.start[i + 1]], s.counts[s.start[i]:s.start[i + 1]]):
                got[k][terms[s.shard, code][0]] += n
    want = {k: collections.Counter(re.findall(r"[^\x20\x09-\x0D]+", t)) for k, t in docs}
    assert {k: c for k, c in got.items() if c} == {k: c for k, c in want.items() if c}
    assert {(r.k, r.n_words, r.n_distinct) for r in m.row_totals().collect()} == {
        (k, sum(c.values()), len(c)) for k, c in want.items()}
