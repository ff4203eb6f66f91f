"""Whole results of earlier operators against brute force."""

import collections
import math
import random
import re
import zlib

from stratus.llm import secret_scan, sharding, span_dedup

DOCS = "doc_id long, text string, lang string, source string, n int"
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], DOCS)


# ---------------------------------------------------------------- secret scan

def tail(z):
    return 1 / (1 + math.exp(min(300.0, 1.5976 * z + 0.07056 * z ** 3)))


def battery(token):
    """Size of the alphabet, squared counts, p-value under uniform draws."""
    if re.fullmatch("[0-9a-f]+|[0-9A-F]+", token):
        alphabet, chars = secret_scan.ALPHABETS["hex"], token.lower()
    elif re.fullmatch("[A-Z2-7]+", token):
        alphabet, chars = secret_scan.ALPHABETS["base32"], token
    else:
        alphabet, chars = secret_scan.ALPHABETS["base64"], token.replace("-", "+").replace("_", "/")
    codes, n, size = [alphabet.index(c) for c in chars], len(token), len(alphabet)
    squares = sum(v * v for v in collections.Counter(codes).values())
    chi = (size / n * squares - n - (size - 1)) / math.sqrt(2 * (size - 1) * (n - 1) / n)
    high = [c >= size / 2 for c in codes]
    up, down = sum(high), n - sum(high)
    mean = 2 * up * down / n + 1
    turns = 1 + sum(a != b for a, b in zip(high, high[1:]))
    runs = (turns - mean) / math.sqrt(max(1e-9, (mean - 1) * (mean - 2) / (n - 1))) if up and down else 9.0
    centre = sum(codes) / n
    variance = sum((c - centre) ** 2 for c in codes)
    covariance = sum((a - centre) * (b - centre) for a, b in zip(codes, codes[1:]))
    serial = covariance / variance * math.sqrt(n) + 1 / math.sqrt(n) if variance > 1e-9 else 9.0
    return size, squares, min(1.0, 3 * min(tail(chi), 2 * tail(abs(runs)), 2 * tail(abs(serial))))


def plain_secrets(rows):
    known, near = [], []
    for _, text in rows:
        text, spans = text or "", []
        spans += [(m.start(), m.end(), "assign", 0) for m in re.finditer(
            r"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text, re.I) if len(m.group(1)) >= 8]
        spans += [(m.start(), m.end(), "access", 1) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m.group()) >= 16]
        spans += [(m.start(), m.end(), "hex", 2) for m in re.finditer("[0-9a-f]+", text) if len(m.group()) >= 32]
        known.append(spans)
        near.append([(m.start(), m.end(), m.group()) for m in re.finditer("[A-Za-z0-9+/_-]{20,}", text)
                     if not any(s[0] < m.end() and m.start() < s[1] for s in spans)])
    times = collections.Counter(t for n in near for _, _, t in n if not t.isdigit())
    many, full = sum(times.values()) or 1, secret_scan.FULL_LENGTH
    letters = [t for t in times if re.fullmatch("[A-Za-z]+", t)]
    pairs = sum(len(t) * (len(t) - 1) * times[t] for t in letters)
    rate = sum((battery(t)[1] - len(t)) * times[t] for t in letters) / pairs if pairs else secret_scan.TEXT_RATE
    length = sum(min(len(t), full) * times[t] for t in times) / many
    steps = collections.Counter()
    at = {}
    for t in times:
        size, squares, uniform = battery(t)
        if uniform < secret_scan.RANDOM_P:
            continue
        n, excess = len(t), max(rate, 2 / size) * size - 1
        z = ((size - 1) + (n - 1) * excess - (size / n * squares - n)) / math.sqrt(2 * (size - 1) + 4 * n * excess)
        at[t] = math.ceil(secret_scan.GRID * math.log10(max(1e-300, tail(z) / (min(n, full) / length))))
        steps[at[t]] += times[t]
    found, bound = 0, None
    for step in sorted(steps):
        found += steps[step]
        if 10 ** (step / secret_scan.GRID) <= secret_scan.FALSE_SHARE * found / many:
            bound = step
    out = []
    for (doc_id, _), spans, tokens in zip(rows, known, near):
        random_ = [(a, b, "random", 3) for a, b, t in tokens if t in at and bound is not None and at[t] <= bound]
        out.append((doc_id, ",".join(f"{k}:{a}:{b}" for a, b, k, _ in sorted(spans + random_, key=lambda s: (s[0], s[3]))), len(random_)))
    return collections.Counter(out)


def test_random_spans(spark):
    rng = random.Random(8)
    letters, base64 = "abcdefghijklmnopqrstuvwxyz", secret_scan.ALPHABETS["base64"]
    rows = []
    for k in range(300):
        words = ["".join(rng.choice("etaoinsrhl") for _ in range(rng.randrange(2, 9))) for _ in range(40)]
        for _ in range(rng.choice([0, 0, 1, 2])):
            words.insert(rng.randrange(40), rng.choice([
                "".join(rng.choice(base64) for _ in range(rng.randrange(20, 90))),
                "".join(rng.choice("0123456789ABCDEF") for _ in range(rng.randrange(20, 60))),
                "".join(rng.choice("etaoinsrhldcu") for _ in range(rng.randrange(20, 50))),
                "".join(rng.choice(letters) for _ in range(25)), "abcdefghijklmnopqrstuvwxyzABCDEFGH", "x" * 40, "1234567890" * 3,
                "path/to/some/module_name-with-parts", 'api_key="%s"' % "".join(rng.choice(base64[:62]) for _ in range(30)),
                "AKIA" + "".join(rng.choice("ABCDEFGH2345") for _ in range(16)),
                "".join(rng.choice("0123456789abcdef") for _ in range(40)) + "Zz"]))
        rows.append((k, " ".join(words)))
    rows += [rows[1]] * 3 + [(None, rows[2][1]), (900, None), (901, "")]
    want = plain_secrets(rows)
    assert sum(n for _, _, n in want) > 50
    got = secret_scan.scan_secrets(frame(spark, rows)).collect()
    assert collections.Counter((r.doc_id, r.spans, r.n_random) for r in got) == want


# ------------------------------------------------------------- substring dedup

def plain_removed(rows):
    """Sentences covered by any run, of at least so many sentences and words,
    whose words stand in an earlier place: all runs are tried."""
    parsed = []
    for doc_id, text in rows:
        pieces = [p for p in re.findall(r"(?s).*?(?:[.!?](?=[\x20\x09-\x0D]|$)|\n|\Z)", text or "") if p]
        words = [re.findall(r"[0-9a-z\x80-\U0010ffff]+", p.translate(FOLD)) for p in pieces]
        parsed.append((doc_id, text, [w for w in words if w]))
    first, out = {}, []
    order = sorted(range(len(parsed)), key=lambda k: (parsed[k][0] is not None, parsed[k][0] or 0, k))
    for k in order:
        own, gone = parsed[k][2], set()
        seen = []
        for i in range(len(own)):
            words = []
            for j in range(i, len(own)):
                words += own[j]
                if (j > i and len(words) >= span_dedup.MIN_WORDS) or (j == i and len(words) >= span_dedup.ALONE):
                    key = tuple(words)
                    if first.setdefault(key, (k, i)) != (k, i):
                        gone.update(range(i, j + 1))
                    seen.append(key)
        out.append((parsed[k][0], len(own), len(gone)))
    return collections.Counter(out)


def test_all_runs_of_sentences(spark):
    """The hashed shortest runs cover what all runs cover."""
    rng = random.Random(3)
    pool = [" ".join(f"w{rng.randrange(9000)}" for _ in range(rng.choice([1, 3, 6, 9, 15, 55]))).capitalize() + rng.choice(".!?") for _ in range(60)]
    rows = []
    for k in range(120):
        own = [" ".join(f"o{rng.randrange(10 ** 9)}" for _ in range(rng.randrange(2, 20))) + "." for _ in range(rng.randrange(0, 6))]
        for _ in range(rng.randrange(0, 3)):
            at, n = rng.randrange(50), rng.randrange(1, 9)
            own[rng.randrange(len(own) + 1):0] = pool[at:at + n]
        rows.append((k, " ".join(own)))
    rows += [(500, None), (501, ""), (502, "one. two. three.")]
    got = span_dedup.remove_repeated_spans(frame(spark, rows)).collect()
    assert collections.Counter((r.doc_id, r.n_sentences, r.n_removed) for r in got) == plain_removed(rows)
    assert sum(r.n_removed for r in got) > 100


# ------------------------------------------------------------------- sharding

def test_text_crc(spark):
    rows = [(1, "abc"), (2, "é\U0001f600"), (3, ""), (4, None), (None, "x" * 100_000)]
    got = {(r.doc_id, r.size, r.text_crc32) for r in sharding.shard_documents(frame(spark, rows)).collect()}
    assert got == {(d, len((t or "").encode()) + 16, None if t is None else zlib.crc32(t.encode())) for d, t in rows}
