from __future__ import annotations

import subprocess
import sys
from pathlib import Path

import corpus_pipeline
from tallybook.llm import decision_list, pieces, simhash, toxicity
from tests.conftest import ROOT
from tests.llm.test_decision_list import plain as plain_counts
from tests.llm.test_simhash import plain_fingerprint, plain_groups
from tests.llm.test_winnowing import plain as plain_hits


def test_stages_against_brute_force(spark, small):
    """Each stage on all its predecessor kept; models are refitted, decisions made row by row."""
    documents, labels, items = (spark.read.parquet(f"{small}/{t}.parquet") for t in ("documents", "labels", "benchmark"))
    rows = {r.doc_id: r for r in documents.collect()}
    rules = decision_list.learn(documents, labels)
    judged = {r.doc_id: r.kept for r in decision_list.judged(documents, rules).collect()}
    for k, r in rows.items():
        n, _, _, _, repeated = plain_counts(r.text)
        assert not judged[k] or (n >= 50 and 100 * repeated <= 50 * n)
    kept = [k for k in sorted(rows) if judged[k]]

    left = documents.where(documents.doc_id.isin(kept))
    scores = {r.doc_id: r.predicted for r in toxicity.scored(left, toxicity.train(left, labels)).collect()}
    kept = [k for k in kept if not scores[k]]
    groups = plain_groups([plain_fingerprint(rows[k].text) for k in kept], 3)
    kept = [k for n, k in enumerate(kept) if groups[n] == n]
    passages = [(r.item_id, r.text) for r in items.collect()]
    kept = [k for k in kept if plain_hits(rows[k].text, passages)[1] == 0]

    vocabulary = pieces.load()
    found = {r.doc_id: pieces.decode(r.ids, vocabulary) for r in corpus_pipeline.run(spark, small).collect()}
    assert found == {k: rows[k].text for k in kept}


def test_outputs_stay_where_the_caller_names_a_folder(spark, small, tmp_path, monkeypatch):
    monkeypatch.setattr(corpus_pipeline, "STAGES", [("a", lambda _, docs, __: docs), ("b", lambda _, docs, __: docs.limit(5)), ("c", lambda _, docs, __: docs)])
    assert corpus_pipeline.run(spark, small, str(tmp_path)).count() == 5
    assert sorted(x.name for x in tmp_path.iterdir()) == ["0-a", "1-b", "2-c"]
    (path,) = {x.rsplit("/", 2)[0] for x in corpus_pipeline.run(spark, small).inputFiles()}
    assert [x.name for x in Path(path.removeprefix("file:").replace("///", "/")).iterdir()] == ["2-c"]


def test_stages_keep_the_columns(spark, small, edge_documents, no_documents):
    assert [name for name, _ in corpus_pipeline.STAGES][2] == "simhash_near_dedup" and len(corpus_pipeline.STAGES) == 5
    for docs in (edge_documents, no_documents):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            result = stage(spark, docs, small)
            assert result.columns == docs.columns and result.count() <= docs.count()


def test_the_rest_does_without_the_folders(tmp_path):
    """With the operators hidden, the entry point still lists the other queries."""
    code = (
        "import sys; sys.modules['tallybook.llm'] = None; import __spark_entry__ as e; "
        "assert e.queries() and not [q for q in e.queries() if q.startswith('op') or q == 'pipeline']"
    )
    subprocess.run([sys.executable, "-c", code], cwd=ROOT, check=True, timeout=120)
