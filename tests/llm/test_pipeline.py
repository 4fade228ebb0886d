"""Each stage on its own input, and the whole against the stages in plain Python."""

from __future__ import annotations

import weakref
from collections import Counter, defaultdict

import corpus_pipeline
import pyarrow as pa
from conftest import SMALL_DIR
from pyspark.sql import functions as F
from test_duplicates import brute_classes

from weir.llm import dart_minhash, mixing, pieces, quality_rules
from weir.llm.common import read, stored
from weir.llm.queries import PIECES
from weir.session import TEXT_ROWS, configure_texts


def test_stages_by_brute_force(spark):
    docs = read(spark, SMALL_DIR, "documents")
    columns = docs.columns
    stages = [f for _, f in corpus_pipeline.STAGES]

    good = stored(spark, stages[0](spark, docs, SMALL_DIR), "t")
    trees = quality_rules.learn(docs, read(spark, SMALL_DIR, "labels"))
    rows = docs.collect()
    verdicts = quality_rules.verdicts([r.text for r in rows], trees, 0.5)["kept"]
    assert sorted(r.doc_id for r in good.collect()) == sorted(r.doc_id for r, k in zip(rows, verdicts) if k)

    cut = stored(spark, stages[1](spark, good, SMALL_DIR), "t")
    sites, first = defaultdict(set), {}
    for r in good.collect():
        for line in filter(None, map(str.strip, r.text.split("\n"))):
            sites[line].add(r.source)
            first[line] = min(r.doc_id, first.get(line, r.doc_id))
    expected = {}
    for r in good.collect():
        lines = r.text.split("\n")
        kept = [x for x in lines if len(sites.get(x.strip(), ())) < 10 or first[x.strip()] == r.doc_id]
        if len(kept) == len(lines) or "".join(kept).strip():
            expected[r.doc_id] = ("\n".join(kept), len("\n".join(kept)) if kept != lines else r.n_chars)
    assert {r.doc_id: (r.text, r.n_chars) for r in cut.collect()} == expected

    one = stored(spark, stages[2](spark, cut, SMALL_DIR), "t")
    classes = brute_classes([(r.doc_id, r.text) for r in cut.collect()])
    assert sorted(r.doc_id for r in one.collect()) == sorted(set(classes.values()))

    mixed = stored(spark, stages[3](spark, one, SMALL_DIR), "t")
    plan = mixing.mix(one, mixing.cycling_schedules(one)).collect()
    assert Counter(r.doc_id for r in mixed.collect()) == Counter({r.doc_id: len(r.positions) for r in plan if r.positions})
    for frame in (good, cut, one, mixed):
        assert frame.columns == columns

    last = stages[4](spark, mixed, SMALL_DIR).collect()
    assert all(r.round_trip for r in last)
    whole = corpus_pipeline.run(spark, SMALL_DIR).collect()
    assert Counter((r.doc_id, tuple(r.ids)) for r in whole) == Counter((r.doc_id, tuple(r.ids)) for r in last)


def test_stages_on_an_empty_table_and_odd_rows(spark):
    rows = [(1, None, "en", None, None), (None, "", "en", "s", 0), (2, "a " * 60, None, "s", 120), (2, "a " * 60, None, "s", 120)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    for frame in (docs, docs.limit(0)):
        for _, stage in corpus_pipeline.STAGES:
            stage(spark, frame, SMALL_DIR).collect()


def test_columns_of_any_name_go_through(spark):
    """Names that operators use themselves are kept as they came, to the last stage."""
    names = ["position", "positions", "taken", "target", "source_size", "size", "lines_removed"]
    docs = read(spark, SMALL_DIR, "documents").limit(60)
    odd = docs.select("*", *[F.concat(F.lit(n), F.col("doc_id")).alias(n) for n in names])
    for name, stage in corpus_pipeline.STAGES[:-1]:
        odd = stored(spark, stage(spark, odd, SMALL_DIR), "odd")
        assert odd.columns == [*docs.columns, *names], name
    rows = odd.collect()
    assert rows and all(r[n] == f"{n}{r.doc_id}" for r in rows for n in names)


def test_stages_hand_few_texts_at_once_to_python(spark):
    """10,000 whole texts a batch, held by Spark, Arrow and the worker, took an executor's memory."""
    docs = read(spark, SMALL_DIR, "documents").limit(50)
    many = spark.range(5000, numPartitions=1)
    rows = many.mapInArrow(lambda batches: (pa.RecordBatch.from_pydict({"n": [b.num_rows]}) for b in batches), "n bigint")
    for name, stage in corpus_pipeline.STAGES:
        for key in TEXT_ROWS:
            spark.conf.unset(key)
        assert stage(spark, docs, SMALL_DIR).columns
        assert max(r.n for r in rows.collect()) <= 1000, name
        assert int(spark.conf.get("spark.sql.parquet.columnarReaderBatchSize")) <= 512, name
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    configure_texts(spark)
    assert spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == "7"
    for key in TEXT_ROWS:
        spark.conf.unset(key)


def test_workers_forget_what_another_operator_remembers():
    """Else a worker that encoded keeps the model and its parts through all later stages."""
    with open(PIECES, "rb") as f:
        model = pieces._model(f.read())
    model.encode("some words to remember")
    gone = weakref.ref(model)
    del model
    rows = pa.RecordBatch.from_pydict({"text": ["a b c"]})
    assert [part.num_rows for part in dart_minhash._slices([rows])] == [1]
    assert gone() is None
