"""The corpus pipeline against the same five steps in plain Python."""

import collections
import hashlib
import math
import zlib

import numpy as np

import corpus_pipeline
from staffflow.llm import chunks, toxicity
from tests.conftest import SMALL
from tests.llm.test_operators import expected_groups, words


def bare(text):
    return " ".join(w for w in (x.strip(".,;:!?\"'()[]") for x in text.lower().split()) if w)


def targets_of(size):
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(sorted(size, key=lambda s: (s is None, (s or "").encode())))}
    capped = set()
    while True:
        left = 1.5 * sum(size.values()) - sum(2 * size[s] for s in capped)
        per = left / sum(w for s, w in weight.items() if s not in capped)
        over = {s for s in size if s not in capped and weight[s] * per >= 2 * size[s]}
        if not over:
            return {s: 2 * size[s] if s in capped else weight[s] * per for s in size}
        capped |= over


def mixed(docs, quality):
    """(doc_id, text) of every copy."""
    by_source = collections.defaultdict(list)
    for d in docs:
        u = (int(hashlib.md5(str(d.doc_id).encode()).hexdigest()[:12], 16) + 0.5) / 2**48
        w = {1: 2.0, 0: 0.5}.get(quality.get(d.doc_id), 1.0)
        by_source[d.source].append((-(u ** (1 / w)), d.doc_id, d))
    size = {s: sum(len(words(d.text)) for *_, d in rows) for s, rows in by_source.items()}
    goal = targets_of(size)
    out = []
    for s, rows in by_source.items():
        epochs = int(goal[s] // size[s])
        rest = math.floor(goal[s]) - epochs * size[s]
        for _, _, d in sorted(rows, key=lambda r: r[:2]):
            out += [(d.doc_id, d.text)] * epochs
            n = len(words(d.text))
            take = min(n, rest)
            rest -= take
            if take:
                out.append((d.doc_id, d.text if take == n else " ".join(words(d.text)[:take])))
    return out


def test_run_equals_plain_steps(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    toxic = {r.doc_id for r in toxicity.toxicity(docs, labels).collect() if r.predicted}
    left = [r for r in docs.collect() if r.doc_id not in toxic]
    first = {d for d, _, least in expected_groups([(r.doc_id, r.text) for r in left]) if d == least}
    items = [bare(r.text) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    left = [r for r in left if r.doc_id in first and not any(x in bare(r.text) for x in items)]
    quality = {r.doc_id: r.quality for r in labels.collect()}
    library = chunks.load(chunks.vocabulary(corpus_pipeline.TOKENIZER))
    want = collections.Counter()
    for doc_id, text in mixed(left, quality):
        ids = [*library.encode(text, add_special_tokens=False).ids, 0]
        want[doc_id, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())] += 1
    rows = corpus_pipeline.run(spark, SMALL).collect()
    assert collections.Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in rows) == want
    place = 0
    for r in sorted(rows, key=lambda r: r.start):
        assert r.start == place
        place += r.n_tokens


def test_stages_keep_columns_and_take_odd_rows(spark):
    """Every stage on nulls, empty texts, repeated rows and further columns; and on no rows."""
    from tests.llm.test_operators import AWKWARD, SCHEMA

    for rows in (AWKWARD, []):
        docs = spark.createDataFrame(rows, SCHEMA)
        for _, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, SMALL)
            assert out.columns == docs.columns
            docs = spark.createDataFrame(out.collect(), SCHEMA)
        assert corpus_pipeline.STAGES[-1][1](spark, docs, SMALL).count() == docs.count()


def test_stages_send_small_batches_to_python(spark, monkeypatch):
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    try:
        for given, after in (("10000", "1024"), ("0", "1024"), ("100", "100")):
            spark.conf.set(name, given)
            stage = corpus_pipeline.leaves_nothing(lambda _spark, docs, _dir: docs)
            stage(spark, spark.range(3).selectExpr("id AS doc_id"), "")
            assert spark.conf.get(name) == after
    finally:
        spark.conf.set(name, before)
