"""The conversation trie against a plain trie built in memory."""

import collections
import hashlib
import random
import zlib

import pytest

from stratus.llm import prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string, depth int, tail string, conv long"


def plain_trie(rows):
    def tie(r):
        role, text = r[2] or "", r[3] or ""
        return (r[1] is not None, r[1] or 0, hashlib.md5(f"{len(role.encode())}:{role}{text}".encode()).hexdigest())

    turns = collections.defaultdict(list)
    for r in sorted((r for r in rows if r[0] is not None), key=tie):
        turns[r[0]].append((r[2] or "", r[3] or ""))
    built = {}
    for c in turns:
        h = zlib.crc32(str(c).encode()) % 9
        base = c - (c % 5 if c >= 0 else -(-c % 5))
        built[c] = turns.get(base, [])[:h] + turns[c][h:]
    members = collections.defaultdict(list)
    for c in sorted(built):
        for d in range(len(built[c]) + 1):
            members[tuple(built[c][:d])].append(c)
    children = collections.Counter(k[:-1] for k in members if k)
    saved, leaves = collections.Counter(), collections.Counter()
    for key, who in members.items():
        for d in range(len(key) + 1):
            saved[key[:d]] += (len(who) - 1) * (len(key[-1][1].encode()) if key else 0)
            leaves[key[:d]] += children[key] == 0
    return collections.Counter((
        who[0], len(key), members[key[:-1]][0] if key else None, len(who), children[key], leaves[key], saved[key],
        hashlib.sha256(",".join(str(c) for c in who if len(built[c]) == len(key)).encode()).hexdigest())
        for key, who in members.items())


def conversations(seed):
    rng, rows = random.Random(seed), []
    opening = [("system", "be kind"), ("user", "héllo"), ("user", "")]
    for c in range(-12, 90):
        if rng.random() < 0.15:
            continue
        for t in range(rng.choice([1, 2, 3, 5, 9, 14])):
            role, text = rng.choice(opening) if t < 4 and rng.random() < 0.9 else ("user", f"turn {rng.randrange(40)}")
            rows.append((c, None if rng.random() < 0.05 else t, None if rng.random() < 0.05 else role,
                         None if rng.random() < 0.05 else text))
    rows += [(c, t, "user", "the same long talk") for c in range(200, 260) for t in range(12)]
    rows += [(500, t, "a", "x" * (t % 7)) for t in range(130)] + [(505, t, "a", "x" * (t % 7)) for t in range(140)]
    rows += [(7, 3, "user", "tie b"), (7, 3, "user", "tie a"), (7, 3, "user", "tie a"), (None, 0, "user", "nobody"),
             (600, 0, "user", "ab"), (601, 0, "use", "rab"), (700, 0, "user", "long " * 50_000)]
    rng.shuffle(rows)
    return [(*r, 5, "x", 9) for r in rows]


@pytest.mark.parametrize("seed, segment, bits, partitions", [(1, 1024, 27, 8), (2, 4, 27, 8), (3, 5, 10, 23)])
def test_trie(spark, seed, segment, bits, partitions, monkeypatch):
    """Also where conversations span segments and partitions, and with so small a sketch that most proofs fail."""
    rows = conversations(seed)
    monkeypatch.setattr(prefix_trie, "SEGMENT", segment)
    old = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = prefix_trie.conversation_trie(spark.createDataFrame(rows, SCHEMA), segment, bits)
        assert got.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
        assert collections.Counter(map(tuple, got.collect())) == plain_trie(rows)
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_tails_stay_where_they_stand(spark):
    """Of conversations with nothing in common only the first prefixes are grouped."""
    rows = [(c, t, "user", f"{c} {t}", 0, "", 0) for c in range(0, 2000, 5) for t in range(20)]
    pieces, _, onward = prefix_trie.rebuilt_pieces(spark.createDataFrame(rows, SCHEMA))
    screened = prefix_trie.screened_prefixes(prefix_trie.prefix_digests(pieces, onward))
    tails, exact = screened.where("tail").count(), screened.where("not tail").count()
    assert 395 <= tails <= 400 and exact < 60


def test_trie_of_nothing(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert prefix_trie.conversation_trie(empty).collect() == []
    one = spark.createDataFrame([(3, 0, "user", "a", 0, "", 0)], SCHEMA)
    assert collections.Counter(map(tuple, prefix_trie.conversation_trie(one).collect())) == plain_trie([(3, 0, "user", "a")])
