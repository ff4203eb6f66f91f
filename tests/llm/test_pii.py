"""Personal data against plain regular expressions and plain counts."""

import collections
import hashlib
import math
import random
import re

import pytest

from stratus.llm import pii

DOCS = "doc_id long, text string, key int, known string, windows int, count int, term string"
EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
TERM = re.compile(pii.TERM)


def digits(s):
    return re.sub("[^0-9]", "", s)


def luhn(d):
    return 12 <= len(d) <= 19 and sum(sum(divmod(int(c) * (1 + k % 2), 10)) for k, c in enumerate(reversed(d))) % 10 == 0


VALID = {"email": lambda f: True, "ip": lambda f: all(int(p) <= 255 for p in f.split(".")),
         "card": lambda f: luhn(digits(f)), "phone": lambda f: 9 <= len(digits(f)) <= 15}
KINDS = [("email", EMAIL), ("ip", IP), ("card", CARD), ("phone", PHONE)]


def base(text):
    spans = [(m.start(), k, m.end(), kind) for k, (kind, p) in enumerate(KINDS) for m in p.finditer(text) if VALID[kind](m.group())]
    return sorted(spans)


def terms_of(rows):
    """Plain statistics: the disclosing terms and whether they are generalised."""
    docs = {row: t or "" for row, (_, t) in enumerate(rows)}
    near = []
    for key, text in docs.items():
        if not base(text):
            continue
        for kind, p in (KINDS[0], KINDS[3], KINDS[2], KINDS[1]):
            text = p.sub(lambda m, kind=kind: f" \x01{kind[0]}" + "".join(
                chr(ord(c) + 55) if c.isdigit() else c for c in hashlib.md5((
                    m.group().lower() if kind == "email" else m.group() if kind == "ip" else digits(m.group())).encode()).hexdigest())
                + " " if VALID[kind](m.group()) else m.group(), text)
        words = re.findall(r"\x01[a-z]+|" + pii.TERM, text)
        for at, w in enumerate(words):
            if w[0] == "\x01":
                around = [x for x in words[max(0, at - pii.REACH):at + pii.REACH + 1] if x[0] != "\x01" and eligible(x)]
                near += [(key, w, tuple(around), x.lower()) for x in around]
    of, both, contexts, by_class = (collections.defaultdict(set) for _ in range(4))
    for key, entity, context, term in near:
        of[entity].add(key)
        both[entity, term].add(key)
        contexts[entity, term].add(context)
        by_class[entity, term[:3]].add(key)
    with_term, with_class = collections.Counter(), collections.Counter()
    for text in docs.values():
        words = {w.lower() for w in TERM.findall(text) if eligible(w)}
        with_term.update(words)
        with_class.update({w[:3] for w in words})
    out = collections.defaultdict(list)
    for entity, term in both:
        ic = math.log(len(docs) / len(of[entity]))
        if ic and with_term[term] and len(contexts[entity, term]) >= pii.MIN_CONTEXTS and 1 + math.log(len(both[entity, term]) / with_term[term]) / ic >= pii.DISCLOSED:
            out[term].append(1 + math.log(len(by_class[entity, term[:3]]) / with_class[term[:3]]) / ic)
    return {t: max(v) < pii.DISCLOSED for t, v in out.items()}


def eligible(w):
    return len(w) >= 3 and not w.isdigit()


def expected(rows):
    terms, out = terms_of(rows), []
    for d, t in rows:
        known = base(t or "")
        marks = [(m.start(), 4 if terms[m.group().lower()] else 5, m.end(), "general" if terms[m.group().lower()] else "remove")
                 for m in TERM.finditer(t or "") if eligible(m.group()) and m.group().lower() in terms
                 and not any(s[0] < m.end() and m.start() < s[2] for s in known)]
        listed = [f"{k}:{a}:{b}" for a, _, b, k in known]
        out.append((d, *[sum(s[3] == k for s in known) for k, _ in KINDS], hashlib.sha256(",".join(listed).encode()).hexdigest(),
                    ",".join(f"{k}:{a}:{b}" for a, _, b, k in sorted(known + marks)), len(marks)))
    return collections.Counter(out)


def corpus(seed):
    rng = random.Random(seed)
    common = ["the", "of", "and", "house", "river", "stone", "Ünder", "42", "x9"] + ["word%d" % k for k in range(60)]
    people = [("annika.holm@mail.example.com", "Annika", "Holmgren"), ("10.20.30.40", "gateway", "Northbridge"),
              ("4111 1111 1111 1111", "Quillfeather", "card"), ("+44 20 7946 0958", "Brackenbury", "office")]
    rows = []
    for k in range(400):
        words = [rng.choice(common) for _ in range(rng.randrange(5, 60))]
        if rng.random() < 0.25:
            value, *names = rng.choice(people)
            at = rng.randrange(len(words))
            words[at:at] = [names[0], value, rng.choice(names), rng.choice(common)]
        if rng.random() < 0.05:
            words.insert(rng.randrange(len(words)), rng.choice(["Annika", "Northbridge", "Brackenbury's", "Quillfeather"]))
        if rng.random() < 0.1:
            words.insert(0, rng.choice(["Holmberg", "Holmes", "gatehouse", "a@b.c@d.e", "x@y.z._foo@bar.com", "1.2.3.4.5.6.7.8", "300.1.1.1", "0000255.1.1.1"]))
        if rng.random() < 0.1:
            words.insert(0, rng.choice(["+1 (269) 555-3296 4524132264652876", "4111-1111-1111-1112", "+12", "5 5 5", "é+49 89 1234567ö",
                                        "abc192.168.0.1", "m@localhost", "@x.y", "a@b.c-d_e@f.g", "12345678901234567890"]))
        rows.append((k, rng.choice([" ", "  ", ", ", "\n"]).join(words)))
    rows += [rows[3]] * 4 + [(5, rows[6][1]), (None, None), (700, None), (701, ""), (None, "Holmgren annika.holm@mail.example.com"),
                             (702, "a" * 3_000), (703, "1" * 3_000), (704, "1." * 3_000), (705, "+1" + " -" * 3_000),
                             (706, "a@" + "b." * 3_000 + "c"), (707, "1 " * 3_000), (708, "\x01efgh Annika annika.holm@mail.example.com"),
                             (709, "u@v.w " * 3_000)]
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_personal_data(spark, seed):
    rows = corpus(seed)
    got = pii.find_personal_data(spark.createDataFrame([(*r, 1, "x", 2, 3, "y") for r in rows], DOCS).repartition(4))
    assert got.columns == ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", "n_terms"]
    want = expected(rows)
    kinds = " ".join(r[6] for r in want)
    assert "remove:" in kinds and "general:" in kinds
    assert collections.Counter(map(tuple, got.collect())) == want


def test_sanitised(spark):
    rows = corpus(1)
    got = {(r.doc_id, r.text) for r in pii.sanitised(spark.createDataFrame([(*r, 1, "x", 2, 3, "y") for r in rows], DOCS)).collect()}
    want = set()
    for (d, *_, spans, _), text in [(next(iter(collections.Counter([r]))), t) for r, t in zip(in_rows(rows), (t for _, t in rows))]:
        if text is None:
            want.add((d, None))
            continue
        out, done = "", 0
        for s in spans.split(",") if spans else []:
            kind, a, b = s.split(":")
            a, b = int(a), int(b)
            out += text[done:max(done, a)]
            if b > done:
                out += text[a:a + 3] + "*" if kind == "general" else "[TERM]" if kind == "remove" else f"[{kind.upper()}]"
            done = max(done, b)
        want.add((d, out + text[done:]))
    assert got == want


def in_rows(rows):
    """``expected`` in the order of the rows."""
    terms, by_row = terms_of(rows), []
    for d, t in rows:
        known = base(t or "")
        marks = [(m.start(), 4 if terms[m.group().lower()] else 5, m.end(), "general" if terms[m.group().lower()] else "remove")
                 for m in TERM.finditer(t or "") if eligible(m.group()) and m.group().lower() in terms
                 and not any(s[0] < m.end() and m.start() < s[2] for s in known)]
        by_row.append((d, ",".join(f"{k}:{a}:{b}" for a, _, b, k in sorted(known + marks)), len(marks)))
    return by_row


def test_very_long_texts(spark):
    """Long runs that almost match, and many matches, in one pass each."""
    texts = ["a" * 500_000, "1" * 500_000, "1." * 200_000, "+1" + " -" * 200_000, "a@" + "b." * 200_000 + "c", "1 " * 200_000,
             "u@v.w " * 50_000, "1.2.3.4 +49 89 1234567 " * 20_000]
    rows = [(k, t, 1, "x", 2, 3, "y") for k, t in enumerate(texts)]
    got = {r.doc_id: (r.n_email, r.n_ip, r.n_card, r.n_phone) for r in pii.find_personal_data(spark.createDataFrame(rows, DOCS)).collect()}
    assert got == {0: (0, 0, 0, 0), 1: (0, 0, 0, 0), 2: (0, 50_000, 0, 0), 3: (0, 0, 0, 0), 4: (1, 0, 0, 0), 5: (0, 0, 0, 0),
                   6: (50_000, 0, 0, 0), 7: (0, 20_000, 19_999, 20_000)}


def test_nothing(spark):
    assert pii.find_personal_data(spark.createDataFrame([], DOCS)).collect() == []
    one = [(1, "mail a@b.cd now")]
    got = pii.find_personal_data(spark.createDataFrame([(*one[0], 1, "x", 2, 3, "y")], DOCS)).collect()
    assert collections.Counter(map(tuple, got)) == expected(one)
