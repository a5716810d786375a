import re
import subprocess
import sys
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from tallybrook.llm import mixing, packing, quality, simhash, surrogates
from tests.conftest import DATA, ROOT
from tests.llm.cases import COLUMNS, awkward, documents, empty
from tests.llm.test_packing import check_layout
from tests.llm.test_simhash import brute_components, brute_print

public_tokenizers = pytest.importorskip("public_tokenizers")


@pytest.fixture(scope="module")
def outputs(spark, tmp_path_factory):
    """What each stage makes of the test documents, written and read again."""
    base, docs, out = tmp_path_factory.mktemp("stages"), documents(spark), []
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, DATA).write.parquet(f"{base}/{i}")
        docs = spark.read.parquet(f"{base}/{i}")
        out.append(docs)
    return out


def test_stages_return_documents(outputs):
    assert [x.columns for x in outputs[:-1]] == [COLUMNS] * 4


def test_rejected_documents_go_and_clean_ones_stay(spark, outputs):
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{DATA}/labels.parquet").collect()}
    judged = quality.judge(documents(spark)).select("doc_id", "quality.base_failed", "quality.kept").collect()
    kept = {r["doc_id"] for r in outputs[0].collect()}
    assert kept == {r["doc_id"] for r in judged if r["kept"]}
    assert {r["doc_id"] for r in judged if labels.get(r["doc_id"]) == 1 and not r["base_failed"]} <= kept


def test_one_document_of_each_group_stays(outputs):
    before = {r["doc_id"]: r["text"] for r in outputs[0].collect()}
    prints = {}
    for i, text in before.items():
        prints.setdefault(brute_print(text), []).append(i)
    after = {r["doc_id"]: r["text"] for r in outputs[1].collect()}
    assert after == {i: before[i] for i in set(brute_components(prints).values())}


def test_personal_data_is_gone(outputs):
    before = {r["doc_id"]: r["text"] for r in outputs[1].collect()}
    for r in outputs[2].collect():
        old = before.pop(r["doc_id"])
        assert not any(old[e.start : e.end] in r["text"] for e in surrogates.entities(old))
    assert not before


def test_sources_meet_their_targets(outputs):
    plan = {r["doc_id"]: r for r in mixing.mixed(outputs[2]).collect()}
    words = {}
    for r in outputs[3].collect():
        words[r["doc_id"]] = words.get(r["doc_id"], 0) + len(re.findall(r"[^\x20\x09-\x0D]+", r["text"]))
    assert words == {i: r["taken"] for i, r in plan.items() if r["taken"]}


def test_all_tokens_are_packed(outputs):
    library = Tokenizer.from_file(public_tokenizers.path(corpus_pipeline.TOKENIZER))
    want = []
    for r in outputs[3].collect():
        ids = np.array([*library.encode(r["text"], add_special_tokens=False).ids, 2], "<u4")
        first = len(ids) if len(ids) <= 1024 else len(ids) % 1024 or 1024
        parts = np.split(ids, range(first, len(ids), 1024))
        want += [(r["doc_id"], k, zlib.crc32(p.tobytes())) for k, p in enumerate(parts)]
    rows = outputs[4].collect()
    assert sorted((r["doc_id"], r["piece"], r["ids_crc32"]) for r in rows) == sorted(want)
    check_layout(rows)


def test_sequences_follow_the_mix(spark, outputs, monkeypatch):
    monkeypatch.setattr(packing.pack_in_order, "__defaults__", (packing.SEQUENCE, 60))
    ranked, order = mixing.with_rank(outputs[3])
    first = [(r["doc_id"], r["source"]) for r in ranked.orderBy(*order).select("doc_id", "source").collect()]
    places = {}
    for at, (i, _) in enumerate(first):
        places.setdefault(i, []).append(at)
    groups = {}
    for r in corpus_pipeline.pack(spark, outputs[3], DATA).collect():
        if len(places[r["doc_id"]]) == 1:
            groups.setdefault(r["sequence_id"] >> 32, []).append(places[r["doc_id"]][0])
    assert len(groups) > 2
    spans = [(min(v), max(v)) for _, v in sorted(groups.items())]
    assert all(a[1] <= b[0] for a, b in zip(spans, spans[1:], strict=False))
    # The order is the one planned: positions of first uses grow.
    planned = {r["doc_id"]: r["position"] for r in mixing.mixed(outputs[2]).collect()}
    seen, positions = set(), []
    for i, _ in first:
        if i not in seen:
            seen.add(i)
            positions.append(planned[i])
    assert positions == sorted(positions)


def test_run_is_the_stages(spark, outputs):
    key = ["doc_id", "piece", "ids_crc32"]
    want = sorted(map(tuple, outputs[-1].select(*key).collect()))
    assert sorted(map(tuple, corpus_pipeline.run(spark, DATA).select(*key).collect())) == want


@pytest.mark.parametrize("make", [awkward, empty])
def test_awkward_documents(spark, make):
    docs = make(spark)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, DATA)
        assert docs.columns == COLUMNS
        docs.collect()
    assert simhash.one_per_group(docs).columns == COLUMNS


def test_the_rest_imports_without_the_text_package():
    code = (
        "import sys\n"
        "class Gone:\n"
        "    def find_spec(self, name, path=None, target=None):\n"
        "        if name in ('tallybrook.llm', 'corpus_pipeline'):\n"
        "            raise ModuleNotFoundError(name, name=name)\n"
        "sys.meta_path.insert(0, Gone())\n"
        "import __spark_entry__ as e\n"
        "assert 'pipeline' not in e.queries() and 'op1_hmm' not in e.queries() and 'dau_stream' in e.queries()\n"
        "assert set(e.oracle_sql()) <= set(e.queries())\n"
    )
    subprocess.run([sys.executable, "-c", code], cwd=ROOT, check=True, timeout=120)
