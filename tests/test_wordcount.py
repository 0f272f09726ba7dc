"""Word count: the documented example and whitespace rules."""

from skyledger.operators import word_count
from skyledger.sources import read_text_files


def test_documented_example(spark, tmp_path):
    folder = tmp_path / "input"
    folder.mkdir()
    (folder / "file2.txt").write_text("Hello Docker\n")
    (folder / "file1.txt").write_text("Hello Hadoop\n")
    got = sorted((r["word"], r["n"]) for r in word_count(read_text_files(spark, str(folder))).collect())
    assert got == [("Docker", 1), ("Hadoop", 1), ("Hello", 2)]


def test_delimiters(spark):
    df = spark.createDataFrame([("  a\tb\n\nc\r\fa  ",), ("",), (None,), ("a b",)], "text string")
    got = sorted((r["word"], r["n"]) for r in word_count(df).collect())
    assert got == [("a", 2), ("a b", 1), ("b", 1), ("c", 1)]


def test_documented_output_text(spark, tmp_path):
    import glob

    from skyledger.operators import write_word_counts

    folder = tmp_path / "input"
    folder.mkdir()
    (folder / "file1.txt").write_text("Hello Hadoop\n")
    (folder / "file2.txt").write_text("Hello Docker\n")
    out = str(tmp_path / "output")
    write_word_counts(word_count(read_text_files(spark, str(folder))), out)
    lines = []
    for part in sorted(glob.glob(f"{out}/part-*")):
        lines += open(part).read().splitlines()
    assert lines == ["Docker\t1", "Hadoop\t1", "Hello\t2"]


def test_wordcount_cli(spark, tmp_path):
    import glob

    from skyledger.plans.wordcount import main

    (tmp_path / "a.txt").write_text("Hello Hadoop\n")
    (tmp_path / "b.txt").write_text("Hello Docker\n")
    out = str(tmp_path / "out")
    main(["--input", str(tmp_path / "a.txt"), str(tmp_path / "b.txt"), "--output", out])
    lines = [ln for part in sorted(glob.glob(f"{out}/part-*")) for ln in open(part).read().splitlines()]
    assert lines == ["Docker\t1", "Hadoop\t1", "Hello\t2"]
