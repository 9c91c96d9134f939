"""The pipeline's stages, one after the other, against brute force over what each was given."""

import re

import pyarrow as pa

import corpus_pipeline
from capplan.llm import common, decontaminate
from tests.llm.test_line_dedup import WORDS, brute as repeated
from tests.llm.test_ngram_join import brute as linked
from tests.test_oracle import SF

SMALL = SF.replace("0.01", "0.001")


def rows(df):
    return sorted(df.collect(), key=lambda r: r.doc_id)


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").where("length(text) < 2000 and doc_id < 100")
    benchmark = [(r.item_id, r.text) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality rules",
        "line dedup",
        "n-gram Jaccard join",
        "benchmark decontamination",
        "best-fit packing",
    ]
    given = rows(docs)
    for number, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, SMALL)
        out.write.parquet(f"{tmp_path}/{number}")
        docs = spark.read.parquet(f"{tmp_path}/{number}")
        if number == 4:
            assert {r.doc_id for r in docs.collect()} == {r.doc_id for r in given}
            return
        kept = {r.doc_id: r for r in rows(docs)}
        assert docs.columns == spark.read.parquet(f"{SMALL}/documents.parquet").columns
        if name == "quality rules":
            assert all(len(WORDS.findall(r.text)) >= 20 for r in kept.values())
            long_ = {r.doc_id for r in given if len(set(WORDS.findall(r.text))) > 60}
            assert long_ - set(kept) == set() or len(long_ - set(kept)) < len(given) // 10
        if name == "line dedup":
            gone = repeated([(r.doc_id, r.text) for r in given])
            for r in given:
                left = [line for k, line in enumerate(r.text.split("\n")) if k not in gone[r.doc_id]]
                if any(re.search(WORDS, line) for line in left):
                    assert kept[r.doc_id].text == "\n".join(left) and kept[r.doc_id].n_chars == len("\n".join(left))
                else:
                    assert r.doc_id not in kept
        if name == "n-gram Jaccard join":
            classes = linked([(r.doc_id, r.text) for r in given])
            assert set(kept) == {d for d, (size, first) in classes.items() if first == d or not size}
        if name == "benchmark decontamination":
            windows = decontaminate.Windows(benchmark, 13)
            for r in given:
                words = decontaminate.words_of(r.text)
                hit = sum(e - s for s, e in windows.scan(words)[0])
                assert (r.doc_id in kept) == (not hit or 20 * hit < len(words))
        given = rows(docs)


def test_run_reads_documents_and_gives_the_last_stage(spark, tmp_path):
    for name in ("documents", "benchmark"):
        spark.read.parquet(f"{SMALL}/{name}.parquet").limit(30).write.parquet(f"{tmp_path}/{name}.parquet")
    packed = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert packed and max(r.offset + r.length for r in packed) <= 2048


def test_a_task_gives_its_memory_back_when_it_ends(spark, monkeypatch):
    """Workers wait beside their executor for the next stage, so they must not keep what a task has freed."""
    batch, events = pa.RecordBatch.from_pydict({"x": [1, 2, 3]}), []
    monkeypatch.setattr(common, "release", lambda: events.append("released"))

    class Frame:
        sparkSession = spark

        @staticmethod
        def mapInArrow(task, schema):
            for b in task(iter([batch, batch])):
                events.append(b.num_rows)

    common.map_arrow(Frame(), lambda: lambda b: iter([b.slice(0, 1), b.slice(1)]), "x long")
    assert events == [1, 2, 1, 2, "released"]
