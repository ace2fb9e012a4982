import glob
import json
import os

import pyarrow.parquet as pq
import pytest

import widevec as wv
from widevec.__main__ import main
from widevec.testing import check_model


@pytest.fixture(scope="module")
def rows(spark):
    pairs = [(i, f"text {i}", None if i % 2 else "b") for i in range(50)]
    return spark.createDataFrame(pairs, "gid long, a string, b string").repartition(4)


def files(path):
    return sorted(glob.glob(f"{path}/*.parquet"))


def as_rows(df):
    return sorted((r.gid, list(r.a), list(r.b)) for r in df.collect())


def test_round_trip_and_overwrite(spark, rows, config, model, tmp_path):
    path = str(tmp_path / "out")
    wv.write_vectors(wv.embed(rows.union(rows), config(), model=model), path)
    found = wv.embed(rows, config(), model=model)
    wv.write_vectors(found, path)
    back = spark.read.parquet(path)
    assert back.schema.simpleString() == "struct<gid:bigint,a:array<float>,b:array<float>>"
    assert as_rows(back) == as_rows(found)


def test_files_are_snappy_with_plain_vectors(rows, config, model, tmp_path):
    path = str(tmp_path / "out")
    wv.write_vectors(wv.embed(rows, config(), model=model), path)
    assert len(files(path)) == 4
    meta = pq.ParquetFile(files(path)[0]).metadata.row_group(0)
    columns = {meta.column(i).path_in_schema: meta.column(i) for i in range(meta.num_columns)}
    assert {c.compression for c in columns.values()} == {"SNAPPY"}
    assert not any("DICTIONARY" in e for e in columns["a.list.element"].encodings)


def test_large_rows_split_files(rows, config, model, tmp_path, monkeypatch):
    monkeypatch.setattr("widevec.sinks.parquet.FILE_BYTES", 10 * (8 + 4 * 8 * 2))
    path = str(tmp_path / "out")
    found = wv.embed(rows, config(), partitions=1, model=model)
    wv.write_vectors(found, path, width=8)
    assert [pq.ParquetFile(f).metadata.num_rows for f in files(path)] == [10] * 5


def test_run_writes_and_counts(spark, rows, config, model, tmp_path):
    path = str(tmp_path / "out")
    for partitions in (None, 3):
        cfg = config(enable_s3_output=True, s3_output_path=path, partitions=partitions)
        done = wv.run(spark, cfg, rows, model=model)
        assert as_rows(done.df) == as_rows(wv.embed(rows, config(), model=model))
        m = done.metrics
        assert (m.source_rows, m.rows_processed, m.rows_written, m.sequences) == (50, 50, 50, 100)
        assert m.seconds > 0 and m.rows_per_second == pytest.approx(50 / m.seconds)


def test_run_reads_its_source(spark, rows, config, model, tmp_path):
    rows.write.parquet(str(tmp_path / "in"))
    source = f"SELECT gid, upper(a) AS a, b FROM parquet.`{tmp_path}/in` WHERE gid < 10"
    cfg = config(source_query=source, enable_s3_output=True, s3_output_path=str(tmp_path / "out"))
    done = wv.run(spark, cfg, model=model)
    assert done.metrics.rows_written == 10
    expected = wv.embed(spark.sql(source), config(), model=model)
    assert as_rows(done.df) == as_rows(expected)


def test_run_of_nothing(spark, rows, config, model, tmp_path):
    cfg = config(enable_s3_output=True, s3_output_path=str(tmp_path / "out"))
    done = wv.run(spark, cfg, rows.filter("gid < 0"), model=model)
    assert (done.metrics.source_rows, done.metrics.rows_written, done.df.count()) == (0, 0, 0)


def test_disabled_output_writes_nothing(spark, rows, config, model, tmp_path):
    path = str(tmp_path / "out")
    done = wv.run(spark, config(s3_output_path=path), rows, model=model)
    assert done.metrics is None and done.df.count() == 50
    assert not os.path.exists(path)


def test_enabled_output_without_a_path(spark, rows, config, model):
    with pytest.raises(ValueError, match="s3_output_path"):
        wv.run(spark, config(enable_s3_output=True), rows, model=model)


def test_failed_run_leaves_the_error(spark, rows, config, model, tmp_path):
    cfg = config(enable_s3_output=True, s3_output_path=str(tmp_path / "out"), embedding_dim=5)
    with pytest.raises(Exception, match="expected"):
        wv.run(spark, cfg, rows, model=model)
    assert not os.path.exists(str(tmp_path / "out" / "_SUCCESS"))


def test_whole_job_from_a_config_file(spark, rows, tmp_path):
    """Model, tokenizer, source and sink all named by one JSON file."""
    rows.write.parquet(str(tmp_path / "in"))
    (tmp_path / "job.onnx").write_bytes(check_model())
    config = {
        "embedding_dim": 8, "max_tokens": 16, "batch_size": 4, "vocab_path": "unused",
        "tokenizer_type": "byt5", "model_path": str(tmp_path / "job.onnx"), "input_columns": ["a", "b"],
        "source_path": str(tmp_path / "in"), "enable_s3_output": True, "s3_output_path": str(tmp_path / "out"),
    }
    (tmp_path / "job.json").write_text(json.dumps(config))
    done = wv.run(spark, wv.EmbedConfig.from_json(str(tmp_path / "job.json")))
    assert done.metrics.rows_written == done.df.count() == 50


def test_command(spark, rows, tmp_path, capsys):
    rows.write.parquet(str(tmp_path / "in"))
    (tmp_path / "command.onnx").write_bytes(check_model())
    config = {
        "embedding_dim": 8, "max_tokens": 16, "batch_size": 4, "vocab_path": "", "tokenizer_type": "byt5",
        "model_path": str(tmp_path / "command.onnx"), "input_columns": ["a", "b"],
        "source_query": f"SELECT * FROM parquet.`{tmp_path}/in`", "s3_output_path": str(tmp_path / "out"),
    }
    path = tmp_path / "job.json"
    path.write_text(json.dumps(config | {"enable_s3_output": True}))
    main([str(path)])
    assert json.loads(capsys.readouterr().out)["rows_written"] == 50
    assert spark.read.parquet(str(tmp_path / "out")).count() == 50
    path.write_text(json.dumps(config))
    with pytest.raises(SystemExit):
        main([str(path)])


def test_lost_tasks_are_run_again_and_counted_once(spark, rows, config, model, tmp_path):
    """Every task fails the first time, halfway through its rows."""

    class Flaky:
        def open(self):
            from pyspark import TaskContext

            infer, calls = model.open(), []

            def once_in_two(ids, mask):
                calls.append(1)
                if TaskContext.get().attemptNumber() == 0 and len(calls) == 2:
                    raise RuntimeError("lost on purpose")
                return infer(ids, mask)

            return once_in_two

    for partitions in (None, 3):
        path = str(tmp_path / f"out-{partitions}")
        cfg = config(enable_s3_output=True, s3_output_path=path, partitions=partitions)
        done = wv.run(spark, cfg, rows, model=Flaky())
        assert (done.metrics.source_rows, done.metrics.rows_written) == (50, 50)
        assert as_rows(done.df) == as_rows(wv.embed(rows, config(), model=model))
