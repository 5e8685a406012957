import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from hopscope.llm import decontaminate, labels, language, preferences, sharding, toxicity
from tests.llm.conftest import odd_rows, sentence


# Sharding


def spread(rows):
    by = {}
    for r in rows:
        by.setdefault(r.shard, []).append(r.slot)
    return by


def test_shards_of_odd_rows(odd, empty):
    rows = sharding.assign_by_text(odd, shards=4).select("doc.doc_id", "doc.shard", "size", F.col("shard").alias("s"), "slot", "text_crc32").collect()
    assert len(rows) == len(odd_rows())
    by = {}
    for r in rows:
        by.setdefault(r.s, []).append(r.slot)
    counts = [len(by.get(s, [])) for s in range(4)]
    assert max(counts) - min(counts) <= 1
    assert all(sorted(v) == list(range(len(v))) for v in by.values())
    assert sharding.assign_by_text(empty, shards=4).count() == 0


def test_groups_stay_together_and_hot_groups_split(small):
    rows = [(i, f"copy {i % 40}") for i in range(120)] + [(1000 + i, "hot") for i in range(200)] + [(5000 + i, f"single {i}") for i in range(280)]
    found = sharding.assign_by_text(small(rows), shards=8).select("doc.text", "shard", "slot").collect()
    by = spread(found)
    assert {len(v) for v in by.values()} == {75} and all(sorted(v) == list(range(75)) for v in by.values())
    groups = {}
    for r in found:
        groups.setdefault(r.text, set()).add(r.shard)
    assert sum(len(groups[f"copy {i}"]) == 1 for i in range(40)) >= 36
    assert len(groups["hot"]) <= 5


def test_general_links_pull_documents_together(spark):
    members = [(f"r{i}", f"k{i // 10}") for i in range(200)] + [(f"r{i}", f"bridge{i // 20}") for i in range(0, 200, 10)]
    placed = sharding.propagate(spark.createDataFrame(members, "row_key string, key string"), 800, 8).select("row_key", "shard").distinct().collect()
    at = {r.row_key: r.shard for r in placed}
    assert len(at) == len(placed) == 200
    pairs = [(f"r{i}", f"r{j}") for i in range(200) for j in range(i) if i // 10 == j // 10]
    assert sum(at[a] == at[b] for a, b in pairs) > 0.8 * len(pairs)


@pytest.mark.parametrize("seed", range(5))
def test_grants_keep_quotas(seed):
    rng = np.random.default_rng(seed)
    n = 6
    requests = rng.integers(0, 50, (n, n)).tolist()
    for i in range(n):
        requests[i][i] = 0
    sizes = [sum(requests[i]) + int(rng.integers(0, 40)) for i in range(n)]
    share = sharding.grants(requests, sizes, 150.0)
    moved = np.array(requests) * np.array(share)
    after = np.array(sizes) - moved.sum(axis=1) + moved.sum(axis=0)
    assert all(a <= max(150.0, s) + 1e-6 for a, s in zip(after, sizes, strict=True))


# Decontamination


def test_leaks(small, spark, odd, empty):
    items = spark.createDataFrame([(1, sentence(30, 1, 0)), (2, sentence(9, 1, 500)), (3, None), (4, ""), (5, "few words")], "item_id long, text string")
    w = sentence(30, 1, 0).split()
    swapped = list(w)
    swapped[4], swapped[11], swapped[20] = "x", "y", "z"
    far = [x if i % 2 else f"q{i}" for i, x in enumerate(w)]
    rows = [
        (1, "before " + " ".join(w) + " after"), (2, "a b " + " ".join(swapped) + " c"), (3, " ".join(far)), (4, " ".join(w[:8])),
        (5, " ".join(w[3:18]).upper() + "."), (6, "in " + sentence(9, 1, 500) + " out"), (7, sentence(40, 1, 5000)), (8, None), (9, "few words"),
    ]
    found = {r.doc_id: {x.item for x in r.leaks} for r in decontaminate.mark_leaks(small(rows), items).collect()}
    assert found == {1: {"1"}, 2: {"1"}, 3: set(), 4: set(), 5: {"1"}, 6: {"2"}, 7: set(), 8: set(), 9: set()}
    kept = decontaminate.drop_leaks(small(rows), items)
    assert {r.doc_id for r in kept.collect()} == {3, 4, 7, 8, 9}
    assert decontaminate.drop_leaks(odd, items).columns == odd.columns
    assert decontaminate.drop_leaks(odd, items.limit(0)).count() == odd.count()
    assert decontaminate.mark_leaks(empty, items).count() == 0


def brute_stretch(near, item, size, span, share):
    """Longest stretch over the hit in which enough words agree."""
    equal = (near == item) & (item != 0)
    r, n, best = decontaminate.AROUND, len(near), 0
    for lo in range(r + 1):
        for hi in range(n - r, n + 1):
            if equal[lo] and equal[hi - 1] and hi - lo >= min(span, size) and equal[lo:hi].sum() >= share * (hi - lo) - 1e-9:
                best = max(best, hi - lo)
    return best


def test_stretches_match_brute_force():
    rng = np.random.default_rng(8)
    width = len(decontaminate.MASKS[0])
    for _ in range(200):
        n = width + 2 * decontaminate.AROUND
        near, item = rng.integers(1, 3, n), rng.integers(1, 3, n)
        near = np.where(rng.random(n) < 0.75, item, near)
        got = decontaminate.best_stretch(near, item, int(rng.integers(5, 40)), 13, 0.8)
        assert got[0] == 0 or got[1] >= 0.8 * got[0] - 1e-9
        size = 40
        assert decontaminate.best_stretch(near, item, size, 13, 0.8)[0] == brute_stretch(near, item, size, 13, 0.8)


# Classifiers


def labelled(spark, n=600):
    rng = np.random.default_rng(1)
    base = [f"word{i}" for i in range(150)]
    rows, marks = [], []
    for i in range(n):
        toxic, good = int(i % 5 == 0), int(i % 3 > 0)
        words = [base[min(149, int(rng.exponential(30)))] for _ in range(120)]
        for at in rng.integers(0, 120, 5 * toxic):
            words[at] = f"vile{rng.integers(0, 30)}"
        if not good:
            words = [x.upper() + "###" for x in words]
        rows.append((i, " ".join(words)))
        marks.append((i, good, toxic))
    return rows, spark.createDataFrame(marks, "doc_id long, quality int, toxic int")


def check_scores(found, marks, column):
    truth = {r.doc_id: r[column] for r in marks.collect()}
    held = [r for r in found.collect() if truth.get(r.doc_id) is not None]
    assert all(0 <= r.score <= 1 for r in held)
    right = sum(r.predicted == truth[r.doc_id] for r in held)
    assert right >= 0.93 * len(held)


def test_toxicity(spark, small, odd, empty):
    rows, marks = labelled(spark)
    model = toxicity.fit(small(rows), marks)
    held = toxicity.score(small(rows), model).filter(labels.held_out(F.col("doc_id")))
    check_scores(held, marks, "toxic")
    scored = toxicity.score(odd, model)
    assert scored.count() == odd.count() and scored.filter("score is null or score < 0 or score > 1").count() == 0
    assert toxicity.score(empty, model).count() == 0
    assert toxicity.fit(small(rows), marks.limit(0)) is None
    assert {r.score for r in toxicity.score(odd, None).collect()} == {0.5}


def test_left_neighbour_sketch():
    rng = np.random.default_rng(0)
    for n in (30, 300, 5000):
        seen = np.zeros((1 << toxicity.STEM_BITS) * toxicity._LEVELS * toxicity._CELLS, bool)
        before = rng.choice(1 << toxicity.STEM_BITS, n, replace=False).astype(np.int64)
        seen[toxicity._cells(before, np.full(n, 7))] = True
        assert 0.3 * n <= toxicity.different(seen)[7] <= 3 * n


def test_quality_ranking(spark, small, odd, empty):
    rows, marks = labelled(spark)
    ranking = preferences.fit(small(rows), marks)
    check_scores(preferences.score(small(rows), ranking).filter(labels.held_out(F.col("doc_id"))), marks, "quality")
    scored = preferences.score(odd, ranking)
    assert scored.count() == odd.count() and scored.filter("score is null or score < 0 or score > 1").count() == 0
    assert preferences.score(empty, ranking).count() == 0
    assert preferences.fit(small(rows), marks.limit(0)) is None


def test_every_labelled_row_is_in_a_pair(spark):
    width = len(preferences.FEATURES)
    rows = [(str(i), int(i < 3), [float(i)] * width) for i in range(100)] + [("7", 0, [7.0] * width)]
    pairs = preferences.preference_pairs(spark.createDataFrame(rows, "id string, label int, features array<double>").repartition(4)).collect()
    assert sorted(p.bad[0] for p in pairs) == sorted([float(i) for i in range(3, 100)] + [7.0])
    used = [sum(p.good[0] == i for p in pairs) for i in range(3)]
    assert sum(used) == 98 and max(used) - min(used) <= 1


def test_quality_fit_takes_all_labelled_rows(spark, small):
    rows, marks = labelled(spark)
    ranking = preferences.fit(small(rows), marks)
    role = {r.doc_id: r.quality for r in marks.filter(~labels.held_out(F.col("doc_id"))).collect()}
    values = np.sort(ranking.value(preferences.measure(pa.array([t for k, t in rows if k in role]))))
    bad = sum(v == 0 for v in role.values())
    assert abs(ranking.cut - (values[bad - 1] + values[bad]) / 2) < 1e-9 and abs(ranking.scale - values.std() / 4) < 1e-9


def test_value_at_a_rank(spark):
    values = np.concatenate([np.random.default_rng(3).normal(size=300) ** 3, np.full(50, 0.25), [1e9, -1e9]])
    frame = spark.createDataFrame([(float(v),) for v in values], "value double")
    for rank in (0, 1, 150, 200, 350, 351):
        assert preferences.at_rank(frame, rank) == np.sort(values)[rank]


def test_labels_of_the_held_out_fold_are_not_read(spark):
    rows = spark.range(400).select(F.col("id").alias("doc_id"), (F.col("id") % 2).cast("int").alias("toxic"))
    role = labels.sample(rows, "toxic", most=50)
    import zlib

    assert len(role) == 100 and all(zlib.crc32(k.encode()) % 4 != 2 for k in role)


def test_features_of_blank_texts():
    got = preferences.measure(pa.array([None, "", " \n", "a | b", "One line.\nOne line.\n\nTwo"]))
    assert not got[:3].any() and got.shape == (5, len(preferences.FEATURES))
    assert abs(got[4][preferences.FEATURES.index("repeated_lines")] - 1 / 3) < 1e-9


# Language


def test_language_fusion(spark, odd, empty):
    english, french = "the of and to in that is was with for ", "le la les des et que dans pour une est "
    train = spark.createDataFrame([(english * 5, "en"), (french * 5, "fr"), (None, "fr"), ("x", None)], "text string, lang string")
    model = language.fit(train)
    rows = [
        (1, english, "en", "a.example.com"), (2, french, None, "b.example.fr"), (3, None, "fr", "b.example.fr"), (4, "", None, None),
        (5, "zz", None, "b.example.fr"), (6, "zz", "en", None), (7, french, "en", "b.example.fr"),
    ]
    rows += [(100 + i, french, "fr", "b.example.fr") for i in range(30)] + [(200 + i, english, "en", "a.example.com") for i in range(30)]
    found = {r.ref: r for r in language.identify(spark.createDataFrame(rows, "ref long, text string, declared string, host string"), model).collect()}
    assert len(found) == len(rows)
    assert {i: found[i].lang for i in (1, 2, 3, 5, 6, 7)} == {1: "en", 2: "fr", 3: "fr", 5: "fr", 6: "en", 7: "fr"}
    assert all(0 < r.probability <= 1.0000001 for r in found.values())
    shaped = odd.select(F.struct("doc_id", "key").alias("ref"), "text", F.col("lang").alias("declared"), F.col("source").alias("host"))
    assert language.identify(shaped, model).count() == odd.count()
    assert language.identify(empty.select(F.col("doc_id").alias("ref"), "text", F.col("lang").alias("declared"), F.col("source").alias("host")), model).count() == 0
    assert language.fit(train.limit(0)) is None
    assert {r.lang for r in language.identify(shaped, None).collect()} == {None}


def test_parts_of_pages(spark):
    rows = [
        ("https://u:p@News.Example.co.uk:80/a?b", '<!DOCTYPE html><HTML class="x" lang="en-GB"><script>var a="<p>"</script><p>Text</p>'),
        ("no address", "<html><!-- lang=\"fr\" -->plain"), (None, None),
    ]
    df = spark.createDataFrame(rows, "url string, html string")
    got = df.select(language.host_of(F.col("url")).alias("h"), language.declared_of(F.col("html")).alias("d"), F.trim(language.visible_text(F.col("html"))).alias("t")).collect()
    assert [tuple(r) for r in got] == [("news.example.co.uk", "en", "Text"), (None, None, "plain"), (None, None, None)]
