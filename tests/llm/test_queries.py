"""The registered corpus queries on the smallest tables, and the pipeline against brute force."""

import collections
import os

import pyarrow.parquet as pq
import pytest

import corpus_pipeline
from __spark_entry__ import queries
from hopscope.llm import decontaminate, rules
from hopscope.llm.queries import QUERIES, tokenizer_path
from tests.llm.conftest import WORD
from tests.llm.test_repeats_near import shingles
from tests.llm.test_rules_secrets import base_spans, measures

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")
COLUMNS = {
    "op1": "doc_id size text_crc32 law shard slot grown_shard",
    "op2": "doc_id n_assign n_access n_hex base_sha256 spans",
    "op3": "doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept",
    "op4": "doc_id held_out score predicted",
    "op5": "doc_id held_out score predicted",
    "op6": "doc_id contaminated",
    "op7": "doc_id class_id n_links",
    "op8": "doc_id page_id lang",
    "op9": "doc_id n_words n_removed kept_sha256",
    "op10": "doc_id n_tokens ids_sha256 decoded_sha256",
    "op11": "doc_id n_runs start length period exponent_milli runs_sha256 collapsed_sha256",
    "op12": "doc_id n_bytes n_tokens over_limit",
}


@pytest.fixture(scope="module")
def texts():
    return pq.read_table(f"{SF}/documents.parquet").to_pylist()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - {"op13_embedding_whitening"}))
def test_one_row_for_each_document(spark, texts, name):
    rows = queries()[name](spark, SF).collect()
    assert set(COLUMNS[name.split("_")[0]].split()) <= set(rows[0].asDict())
    assert sorted(r.doc_id for r in rows if r.doc_id is not None) == sorted(d["doc_id"] for d in texts)


def test_one_row_for_each_vector_and_component(spark):
    rows = queries()["op13_embedding_whitening"](spark, SF).collect()
    vectors = pq.read_table(f"{SF}/embeddings.parquet").to_pylist()
    want = sorted((v["vec_id"], k) for v in vectors for k in range(1, 33))
    assert sorted((r.vec_id, r.component) for r in rows) == want
    assert {r.n for r in rows} == {len(vectors)} and len({r.identity_error for r in rows}) == 1
    assert {"deviation", "whitened", "explained"} <= set(rows[0].asDict())


def kept_by_rules(docs):
    found, hosts = {}, collections.defaultdict(collections.Counter)
    for d in docs:
        n, _, symbols, dup, repeat = measures(d["text"])
        lines = sum(bool(WORD.search(x)) for x in (d["text"] or "").split("\n"))
        failed = {"short": n < 50, "repeats": 100 * repeat > 50 * n, "symbols": 10 * symbols > 5 * n, "dup_lines": 100 * dup > 30 * lines}
        found[d["doc_id"]] = failed
        if d["source"] is not None:
            hosts[d["source"]].update({"n": 1} | {k: int(v) for k, v in failed.items()})
    bad = set()
    for rule in rules.RULES:
        n, f = sum(h["n"] for h in hosts.values()), sum(h[rule] for h in hosts.values())
        a, b = rules.beta_prior(len(hosts), n, sum(h["n"] ** 2 for h in hosts.values()), f, sum(h[rule] ** 2 / h["n"] for h in hosts.values()))
        bad |= {s for s, h in hosts.items() if (h[rule] + a) / (h["n"] + a + b) > rules.HOST_LIMIT}
    return [d for d in docs if not (found[d["doc_id"]]["short"] or found[d["doc_id"]]["repeats"] or d["source"] in bad)]


def one_of_each(docs):
    sets, stays = [shingles(d["text"]) for d in docs], []
    root = list(range(len(docs)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            if a == sets[j] or len(a & sets[j]) >= 0.8 * len(a | sets[j]):
                root[max(top(i), top(j))] = min(top(i), top(j))
    least = {}
    for i, d in enumerate(docs):
        least.setdefault(top(i), d)
        if d["doc_id"] < least[top(i)]["doc_id"]:
            least[top(i)] = d
    stays = {d["doc_id"] for d in least.values()}
    return [d for d in docs if d["doc_id"] in stays]


def plain(text):
    edge = " \t.,;:!?\"'()[]{}«»“”„¿¡*#$%&|<>-_"
    return [w.lower().strip(edge) for w in WORD.findall(text or "")]


def leaks(doc, items, seeds):
    words = plain(doc["text"])
    for mask, shape in enumerate(decontaminate.MASKS):
        places = [i for i, c in enumerate(shape) if c == "1"]
        for at in range(len(words) - len(shape) + 1):
            for item, start in seeds.get((mask, *(words[at + p] for p in places)), ()):
                other, r, width = items[item], decontaminate.AROUND, len(shape)
                equal = [
                    0 <= at + k < len(words) and 0 <= start + k < len(other) and words[at + k] == other[start + k]
                    for k in range(-r, width + r)
                ]
                for lo in range(r + 1):
                    for hi in range(r + width, len(equal) + 1):
                        if equal[lo] and equal[hi - 1] and hi - lo >= min(decontaminate.SPAN, len(other)) and sum(equal[lo:hi]) >= 0.8 * (hi - lo):
                            return True
    return False


def test_pipeline_matches_brute_force(spark, texts):
    tokenizers = pytest.importorskip("tokenizers")
    library = tokenizers.Tokenizer.from_file(tokenizer_path())
    library.no_truncation()
    library.no_padding()
    items = {r["item_id"]: plain(r["text"]) for r in pq.read_table(f"{SF}/benchmark.parquet").to_pylist()}
    seeds = collections.defaultdict(list)
    for item, words in items.items():
        for mask, shape in enumerate(decontaminate.MASKS):
            for at in range(len(words) - len(shape) + 1):
                seeds[mask, *(words[at + i] for i, c in enumerate(shape) if c == "1")].append((item, at))
    docs = kept_by_rules(texts)
    good = len(docs)
    docs = one_of_each(docs)
    single = len(docs)
    docs = [d for d in docs if not leaks(d, items, seeds)]
    assert len(texts) > good > single > len(docs) > 0
    want = {}
    for d in docs:
        text, done, out = d["text"] or "", 0, []
        for start, _, _, end in base_spans(text):
            if start >= done:
                out += [text[done:start], "[SECRET]"]
            done = max(done, end)
        want[d["doc_id"]] = library.encode("".join([*out, text[done:]]), add_special_tokens=False).ids
    got = {r.doc_id: list(r.ids) for r in corpus_pipeline.run(spark, SF).collect()}
    assert got == want


def test_stages_keep_the_columns_and_take_empty_tables(spark, empty):
    docs = empty.select("doc_id", "text", "lang", "source", "n_chars")
    for _, step in corpus_pipeline.STAGES[:-1]:
        assert step(spark, docs, SF).columns == docs.columns
        assert step(spark, docs, SF).count() == 0
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SF).count() == 0
