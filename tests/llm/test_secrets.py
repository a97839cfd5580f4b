"""Secret scan against Python's regular expressions."""

import hashlib
import random
import re

import pytest

from chatlog.llm import secrets

ASSIGN = re.compile(secrets.ASSIGN[4:], re.I | re.A)
PATTERNS = [(0, ASSIGN, 2, 12), (1, re.compile(secrets.ACCESS), 0, 18), (2, re.compile(secrets.HEX), 0, 16)]


def base(text):
    return sorted((m.start(), k, m.end(), m[g]) for k, p, g, n in PATTERNS for m in p.finditer(text or "") if len(m[g]) >= n)


def wide(text):
    spans = base(text)
    found = [(m.start(), 3, m.end(), m[0]) for m in re.finditer(secrets.WIDE, text or "") if re.search("[0-9]", m[0]) and re.search("[A-Za-z]", m[0])]
    return [x for x in found if not any(b[0] < x[2] and x[0] < b[2] for b in spans)]


def fixture():
    rng = random.Random(2)
    token = lambda n: "".join(rng.choice("0123456789abcdef") for _ in range(n))
    rows = []
    shared = "AKIA" + "B" * 16
    for i in range(30):
        parts = rng.choices([f'password = "{token(20)}"', f"API_KEY:{token(8)}", f"secret: tokenX = {token(14)}", f"passwd='{token(12)}'", shared,
                             f"AKIA{'Q7' * 6}", token(15), token(16), f"é🙂 token={token(40)}", f"Zz9{token(30).upper()}-q", "K" * 25, "plain words ä"], k=6)
        rows.append((i, " ".join(parts), f"src{i % 5}", "en"))
    rows += [(40, None, "a", None), (41, "", None, "en"), (1, rows[1][1], "src1", "en"), (1, rows[1][1], "src1", "en"), (None, f"{shared} x", None, None)]
    rows.append((42, "token=" + "a1" * 50000 + f" é {shared} " * 3000, "long", "en"))
    rows.append((43, "Qm9" + "Zx" * 12 + " and " + "Qm9" + "Zx" * 12, "one", "en"))
    rows += [(44 + i, "Copied9" + "Key" * 8, f"own{i}", "en") for i in range(4)]
    return rows


def brute(rows):
    owners = {}
    for _, text, source, lang in rows:
        for x in base(text) + wide(text):
            owners.setdefault(x[3], (set(), set()))
            owners[x[3]][0].add(source or "")
            owners[x[3]][1].add((source, lang))
    own = {v: len(o) <= 1 and len(r) <= 3 for v, (o, r) in owners.items()}
    out = []
    named = lambda xs: ",".join(f"{secrets.KINDS[k]}:{s}:{e}" for s, k, e, _ in sorted(xs))
    for doc, text, _, _ in rows:
        b = base(text)
        kept = b + [x for x in wide(text) if own[x[3]]]
        n = [sum(x[1] == k for x in b) for k in range(3)]
        out.append((doc, *n, hashlib.sha256(named(b).encode()).hexdigest(), named(kept), sum(own[x[3]] for x in kept), sum(not own[x[3]] for x in kept)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("extra", [[], ["'x' AS _id", "'x' AS _all", "'x' AS digest", "'x' AS start", "'x' AS kind", "'x' AS _owner"]])
def test_equals_brute_force(spark, extra):
    rows = fixture()
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string, lang string").selectExpr("*", *extra)
    assert sorted(map(tuple, secrets.scan_secrets(df).collect()), key=repr) == brute(rows)


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id bigint, text string, source string, lang string")
    assert secrets.scan_secrets(df).count() == 0
