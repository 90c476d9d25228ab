from __future__ import annotations

import __spark_entry__ as contract
import corpus_pipeline
from lakeloom.llm import ORACLES, QUERIES, decontam, langid, pieces, pseudonyms, simhash
from lakeloom.llm.queries import PSEUDONYM_KEY, piece_model
from tests.llm.data import FOLDER, awkward
from tests.llm.test_decontam import slow_found
from tests.llm.test_pseudonyms import slow as slow_pseudonyms
from tests.llm.test_simhash import slow_components, slow_fingerprint


def test_contract():
    assert set(QUERIES) | {"pipeline"} <= set(contract.queries())
    assert {int(n[2:].split("_")[0]) for n in QUERIES} == set(range(1, 14))
    assert set(ORACLES) <= set(contract.oracle_sql())


def test_run_matches_the_stages_by_brute_force(spark, monkeypatch):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").collect()
    kept = [r for r in docs if any(c.isalpha() for c in r.text or "")]
    prints = [(r.doc_id, slow_fingerprint(r.text)) for r in kept]
    groups = slow_components(prints, 4)
    kept = [r for r, (i, f) in zip(kept, prints) if groups[f] == i]
    items = [(r.item_id, r.text.encode()) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    index = decontam.Index(items, decontam.WINDOW_BYTES, decontam.EDIT_RATE)
    short = [r for r in kept if len(r.text) < 2500]  # the quadratic alignment takes long
    clean = {r.doc_id for r in short if not slow_found(index, r.text.encode())}
    rows = corpus_pipeline.run(spark, FOLDER).collect()
    assert {r.doc_id for r in rows} <= {r.doc_id for r in kept}
    assert {r.doc_id for r in rows} & {r.doc_id for r in short} == clean
    import tests.llm.test_pseudonyms as brute

    monkeypatch.setattr(brute, "KEY", PSEUDONYM_KEY)
    encoder = pieces.Encoder(piece_model())
    texts = {r.doc_id: r.text for r in docs}
    for r in rows:
        text = slow_pseudonyms(texts[r.doc_id]).encode()
        assert r.ids == encoder.encode([text])[0].tolist()


def test_stages_keep_the_columns_and_stand_awkward_rows(spark):
    docs = spark.createDataFrame(
        [(r.doc_id, r.text, r.lang, r.source, r.n_chars) for r in awkward(spark).collect()],
        "doc_id bigint, text string, lang string, source string, n_chars bigint",
    )
    for start in (docs, docs.limit(0)):
        rows = start
        for _, stage in corpus_pipeline.STAGES[:-1]:
            rows = stage(spark, rows, FOLDER)
            assert rows.columns == docs.columns
        found = corpus_pipeline.STAGES[-1][1](spark, rows, FOLDER).collect()
        ids = [r.doc_id for r in found]
        assert sorted(ids, key=repr) == ([1, 5, 8, None] if start is docs else [])


def test_stages_call_the_operators(spark, monkeypatch):
    """Each stage hands its documents to its operator and returns what that gives."""
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["language_id", "near_duplicates", "decontamination", "pseudonymisation", "encoding"]
    docs = awkward(spark).limit(1)
    operators = [
        (langid, "keep_identified"),
        (simhash, "keep_one"),
        (decontam, "keep_uncontaminated"),
        (pseudonyms, "pseudonymise"),
        (pieces, "encode"),
    ]
    for (_, stage), (module, name) in zip(corpus_pipeline.STAGES, operators):
        given = []
        real = getattr(module, name)
        monkeypatch.setattr(module, name, lambda df, *a, **b: given.append(df) or real(df, *a, **b))
        stage(spark, docs, FOLDER)
        assert given == [docs]
