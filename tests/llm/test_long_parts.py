"""Links of secrets over parts longer than the buckets they are joined by."""

import random
import re

from hopscope.llm import secrets
from tests.llm.test_rules_secrets import base_spans


def linked(text):
    base, soft = [(a, k, b) for a, _, k, b in base_spans(text)], []
    for kind in secrets.KINDS[3:]:
        soft += [(m.start(), kind, m.end()) for m in re.finditer(secrets.PATTERNS[kind].replace("*+", "*"), text, re.A)]
    soft = [s for s in soft if not any(b[0] < s[2] and s[0] < b[2] for b in base)]
    out = list(base)
    for s in soft:
        near = [p[1] for p in base + soft if p[0] <= s[2] + secrets.REACH and p[2] >= s[0] - secrets.REACH]
        ident, secret = (any(k in kinds for k in near) for kinds in (secrets.IDENTIFIERS, secrets.SECRETS))
        if (s[1] == "weak" and ident) or (s[1] == "account" and secret) or (s[1] == "endpoint" and ident and secret):
            out.append(s)
    return sorted(out)


def found(small, texts):
    rows = secrets.find_secrets(small(list(enumerate(texts)))).select("doc.doc_id", "spans").collect()
    return {r.doc_id: sorted((s.start, s.kind, s.end) for s in r.spans) for r in rows}


def test_long_secret_before_its_complement(small):
    texts = [f"{'y ' * k}token={'Ab1' * n} user=bob" for n in (60, 250, 334, 700) for k in (0, 70, 149)]
    texts += [f"{'0123456789abcdef' * 80} login: someone https://h.example/a"]
    got = found(small, texts)
    assert got == dict(enumerate(map(linked, texts)))
    assert all({"account"} <= {k for _, k, _ in spans} for spans in got.values())


def test_reach_at_the_edges_of_buckets(small):
    """A gap of exactly the reach, with ends on multiples of it."""
    hexed = lambda n: ("0123456789abcdef" * 40)[:n]
    texts = []
    for gap in (299, 300, 301):
        texts += [" " * (300 - n) + hexed(n) + " " * gap + "user=bob" for n in (24, 299)]
        texts += [" " * 292 + "user=bob" + " " * gap + hexed(30)]
    got = found(small, texts)
    assert got == dict(enumerate(map(linked, texts)))
    assert {len(spans) for spans in got.values()} == {1, 2}


def test_random_long_parts_match_brute_force(small):
    rng, texts = random.Random(6), []
    for _ in range(120):
        parts = [f"token={'aB3' * rng.randint(3, 500)}", "0a1b2c3d" * rng.randint(3, 200), "Zk3jd93k" * rng.randint(2, 200)]
        parts += ["user: bob", "https://h.example/a" + "b" * rng.randint(0, 900), "y " * rng.randint(1, 250)]
        texts.append(" ".join(rng.choice(parts) for _ in range(7)))
    assert found(small, texts) == dict(enumerate(map(linked, texts)))
