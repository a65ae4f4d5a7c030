"""The pipeline's stages, each on what the one before it kept."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """Input and output of each stage, as tables."""
    folder = tmp_path_factory.mktemp("stages")
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    done = {}
    for name, stage in corpus_pipeline.STAGES:
        path = str(folder / name.replace(" ", "-"))
        stage(spark, docs, SF_DIR).write.parquet(path)
        done[name] = (docs, spark.read.parquet(path))
        docs = done[name][1]
    return done


def texts(df):
    return {r["doc_id"]: r["text"] for r in df.collect()}


def test_every_stage_but_the_last_keeps_the_columns(stages):
    for name, (before, after) in list(stages.items())[:-1]:
        assert after.columns == before.columns, name
        assert dict(after.dtypes) == dict(before.dtypes)
        assert set(texts(after)) <= set(texts(before))


def test_language_stage_keeps_every_document_in_a_language(stages):
    before, after = (texts(df) for df in stages["language ID"])
    gone = set(before) - set(after)
    assert all(not any(c.isalpha() for c in before[i] or "") for i in gone) or len(gone) <= 0.01 * len(before)
    assert all(after[i] == before[i] for i in after)


def plain_shingles(text, width=5):
    words = (text or "").lower().split()
    return {tuple(words[i : i + width]) for i in range(max(1, len(words) - width + 1))} if words else set()


def test_one_document_of_each_group_of_near_duplicates_stays(stages):
    before, after = (texts(df) for df in stages["near-duplicates"])
    sets = {i: plain_shingles(t) for i, t in after.items()}
    kept = sorted(sets)
    for a in kept:
        for b in kept:
            if a < b and sets[a] and sets[b]:
                assert 100 * len(sets[a] & sets[b]) < 80 * len(sets[a] | sets[b]), (a, b)
    gone = set(before) - set(after)
    everything = {i: plain_shingles(t) for i, t in before.items()}
    for i in gone:
        assert any(100 * len(everything[i] & s) >= 80 * len(everything[i] | s) for j, s in everything.items() if j != i)


def test_no_passage_of_the_stages_length_is_left_twice(stages):
    before, after = (texts(df) for df in stages["repeated passages"])
    size = corpus_pipeline.REPEATED_BYTES
    seen = {}
    for i in sorted(before):
        raw = (before[i] or "").encode()
        for p in range(len(raw) - size + 1):
            seen.setdefault(raw[p : p + size], i)
    for i, text in after.items():
        raw, gone = before[i].encode(), set()
        for p in range(len(raw) - size + 1):
            if seen[raw[p : p + size]] < i:
                gone.update(range(p, p + size))
        if not gone:
            assert text == before[i]
        else:  # whole characters are kept, so at least the uncovered bytes are there
            assert len(raw) - len(gone) <= len(text.encode()) < len(raw)


def test_pieces_cover_what_decontamination_left(stages):
    left, pieces = stages["decontamination"][1], stages["packing"][1]
    assert pieces.select("doc_id").distinct().count() == left.select("doc_id").distinct().count()
    ends = pieces.groupBy("sequence_id").agg(
        F.sum("length").alias("n"), F.max(F.col("offset") + F.col("length")).alias("end")
    )
    assert ends.filter("n <> end OR n > 2048").isEmpty()


def test_run_gives_the_last_stages_rows(spark, stages):
    rows = corpus_pipeline.run(spark, SF_DIR)
    last = stages["packing"][1]
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert sorted(map(tuple, rows.select(columns).collect())) == sorted(map(tuple, last.select(columns).collect()))
