import json

import pytest
from conftest import rows

from vocabspark.sources import corpus as src
from vocabspark.sources import vocab as vsrc


@pytest.fixture
def folder(tmp_path):
    lines = ['{"body": "one", "x": 1}', "", "{bad", '{"other": 1}', "null", '{"body": null}']
    (tmp_path / "a.jsonl").write_text("\n".join(lines))
    (tmp_path / "b.txt").write_text("two\nthree\n")
    (tmp_path / "c.csv").write_text("nothing")
    (tmp_path / "_hidden.txt").write_text("nothing")
    return tmp_path


def test_jsonl_keeps_good_lines(spark, folder):
    assert rows(src.read_corpus_jsonl(spark, str(folder / "a.jsonl"), "body")) == [("one",)]


def test_mixed_directory_one_level_deep(spark, folder):
    one = spark.createDataFrame([("four", 4)], "body string, n int")
    one.write.parquet(str(folder / "d"))
    one.write.parquet(str(folder / "e.parquet"))
    one.write.parquet(str(folder / "deep" / "f"))
    got = rows(src.read_corpus(spark, str(folder), "body"))
    assert got == [("four",), ("four",), ("one",), ("three",), ("two",)]


def test_type_is_chosen_by_suffix_not_by_any_part_of_the_name(spark, tmp_path):
    odd = tmp_path / "notes.jsonl.txt"
    odd.write_text("line\n")
    assert rows(src.read_corpus(spark, str(odd))) == [("line",)]


def test_dataset_directory_and_table(spark, tmp_path):
    path = str(tmp_path / "data")
    spark.createDataFrame([("x", 1)], "text string, n int").write.parquet(path)
    assert src.read_corpus(spark, path).columns == ["text"]
    spark.read.parquet(path).createOrReplaceTempView("some_corpus")
    assert rows(src.read_corpus_table(spark, "some_corpus")) == [("x",)]


def test_clear_errors(spark, folder, tmp_path):
    with pytest.raises(FileNotFoundError):
        src.read_corpus(spark, str(tmp_path / "missing"))
    with pytest.raises(ValueError, match="type"):
        src.read_corpus(spark, str(folder / "c.csv"))


def test_convert(spark, folder):
    target = str(folder / "out")
    assert rows(src.convert_corpus(spark, str(folder / "a.jsonl"), target, "body")) == [("one",)]
    assert rows(spark.read.parquet(target)) == [("one",)]


def test_exemplars(spark, tmp_path):
    (tmp_path / "x.json").write_text(json.dumps(["ê°¤", "b"]))
    (tmp_path / "x.txt").write_text("가 나\n다  가")
    assert rows(vsrc.read_exemplars(spark, str(tmp_path / "x.json"), "j")) == [("b", "j"), ("ê°¤", "j")]
    assert len(rows(vsrc.read_exemplars(spark, str(tmp_path / "x.txt"), "t"))) == 3


def test_json_of_unknown_model(spark, tmp_path):
    path = tmp_path / "v.json"
    path.write_text(json.dumps({"added_tokens": [], "model": {"type": "other"}}))
    with pytest.raises(ValueError, match="model"):
        vsrc.read_vocab_json(spark, str(path))


def test_mixed_directory_reads_compressed_files(spark, tmp_path):
    import bz2
    import gzip

    (tmp_path / "a.jsonl").write_text('{"text": "one"}\n')
    (tmp_path / "b.jsonl.gz").write_bytes(gzip.compress(b'{"text": "two"}\n'))
    (tmp_path / "c.txt.bz2").write_bytes(bz2.compress(b"three\n"))
    found = src.read_corpus(spark, str(tmp_path))
    assert sorted(r[0] for r in found.collect()) == ["one", "three", "two"]
