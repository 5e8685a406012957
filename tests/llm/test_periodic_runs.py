import hashlib
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from hopscope.llm import periodic_runs, queries
from tests.llm.conftest import WORD, documents


def brute_runs(words, shortest=6, periods=4):
    """Straight from the definition: every period, every widest stretch, its smallest period checked."""
    n, out = len(words), []
    for q in range(1, n // periods + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j + q - i
            if j > i and length >= max(shortest, periods * q):
                part = words[i : i + length]
                if not any(all(part[t] == part[t + p] for t in range(length - p)) for p in range(1, q)):
                    out.append((i, length, q))
            i = max(j, i + 1)
    return sorted(out, key=lambda r: (r[0], r[2]))


def brute_row(doc_id, text):
    words = WORD.findall(text or "")
    h = zlib.crc32(str(doc_id).encode())
    if h % 10 == 0 and words and doc_id is not None:
        g, n = h // 10, len(words)
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = brute_runs(words)
    dropped = {i for s, length, q in runs for i in range(s + q, s + length)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
    digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return (
        doc_id, len(runs), *best, None if not runs else 1000 * best[1] // best[2],
        digest("".join(f"{s},{length},{q}\n" for s, length, q in runs)),
        digest(" ".join(w for i, w in enumerate(words) if i not in dropped)),
    )


def random_words(rnd):
    out = []
    for _ in range(rnd.randint(1, 4)):
        root = [rnd.randint(0, rnd.choice([1, 1, 2, 5])) for _ in range(rnd.randint(1, rnd.choice([3, 9, 20, 90])))]
        out += root * rnd.randint(1, 7) + root[: rnd.randint(0, len(root))]
    return out[:500]


def test_find_against_definition():
    rnd = random.Random(11)
    for _ in range(1500):
        words = random_words(rnd)
        got = periodic_runs.find(np.array(words, np.int64))
        assert sorted(map(tuple, got.tolist()), key=lambda r: (r[0], r[2])) == brute_runs(words), words


def test_slice_of_many_texts():
    rnd = random.Random(5)
    texts = [" ".join(f"w{w}" for w in random_words(rnd)) for _ in range(60)] + [None, "", " \n ", "la la la", "la " * 6]
    runs, upto, counts, collapsed = periodic_runs.runs_of_slice(pa.array(texts))
    for i, text in enumerate(texts):
        words = WORD.findall(text or "")
        want = brute_runs(words)
        assert [tuple(r) for r in runs[upto[i] : upto[i + 1]].tolist()] == want
        gone = {k for s, length, q in want for k in range(s + q, s + length)}
        assert collapsed[i].as_py() == " ".join(w for k, w in enumerate(words) if k not in gone)
        assert counts[i] == len(words)


def test_runs_do_not_cross_texts():
    runs, *_ = periodic_runs.runs_of_slice(pa.array(["a a a", "a a a", "x a a a"]))
    assert len(runs) == 0


def test_long_texts():
    period = " ".join(f"w{i}" for i in range(1000))
    runs, *_ = periodic_runs.runs_of_slice(pa.array([" ".join([period] * 200), "la " * 200000, " ".join(f"u{i}" for i in range(200000))]))
    assert runs.tolist() == [[0, 200000, 1000], [0, 200000, 1]]


def test_fewer_periods_are_refused():
    with pytest.raises(ValueError, match="four periods"):
        periodic_runs.find(np.zeros(10, np.int64), periods=2)


def test_odd_rows(odd, empty):
    got = periodic_runs.find_runs(odd, carry=["doc_id", "key", "doc"])
    assert got.columns == ["doc_id", "key", "doc", "n_words", "runs", "collapsed"]
    rows = {r["doc_id"]: r for r in got.collect() if r["doc_id"] is not None}
    assert got.count() == odd.count()
    assert rows[1]["n_words"] == 0 and rows[1]["runs"] == [] and rows[1]["collapsed"] == ""
    assert [tuple(r) for r in rows[11]["runs"]] == [(0, 400, 1)] and rows[11]["collapsed"] == "la"
    assert rows[13]["n_words"] == 30000 and rows[13]["runs"] == []
    assert periodic_runs.find_runs(empty).count() == 0
    assert set(periodic_runs.find_runs(odd).columns) == {*odd.columns, "runs", "collapsed"} | {"n_words"}


def test_longest_breaks_ties(spark):
    rows = spark.sql("select array(named_struct('start', 9L, 'length', 8L, 'period', 2L), named_struct('start', 3L, 'length', 8L, 'period', 2L), named_struct('start', 3L, 'length', 8L, 'period', 1L)) runs, 1 k union all select cast(array() as array<struct<start:bigint,length:bigint,period:bigint>>), 2")
    got = {r["k"]: r["best"] for r in rows.select("k", periodic_runs.longest(F.col("runs")).alias("best")).collect()}
    assert tuple(got[1]) == (3, 8, 1) and got[2] is None


def test_query_against_brute_force(spark, tmp_path):
    rnd = random.Random(2)
    rows = [(i, " ".join(f"w{w}" for w in random_words(rnd))) for i in range(160)]
    rows += [(None, "la " * 9), (200, None), (201, ""), (202, " \t "), (203, "one"), (3, rows[3][1]), (204, "é ß " * 5), (205, "x" * 5000)]
    docs = documents(spark, [(i, t, "en", "s", 1) for i, t in rows])
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    got = queries.op11_periodic_runs(spark, str(tmp_path))
    want = [brute_row(i, t) if i is not None else (None, *brute_row(1, t)[1:]) for i, t in rows]
    assert sorted(map(str, (tuple(r) for r in got.collect()))) == sorted(map(str, want))
    assert sum(zlib.crc32(str(i).encode()) % 10 == 0 for i, _ in rows) > 5
