import json
import os
import random

import numpy as np
import pyarrow as pa
import pytest

from pairscore.sources import line_index, tables
from pairscore.sources.aligned import AlignmentError, read_aligned, read_lines, write_aligned

PAIRS = [(f"　स्रोत {i} ", f"目标 {i}", 1.0 + i / 100) for i in range(500)]


def _write(folder, name, lines):
    path = os.path.join(folder, name)
    with open(path, "w", encoding="utf-8") as out:
        out.writelines(f"{line}\n" for line in lines)
    return path


@pytest.fixture()
def files(tmp_path):
    sides = list(zip(*PAIRS))
    return [_write(tmp_path, f"side{i}", side) for i, side in enumerate(sides)]


def test_lines_keep_their_numbers_over_many_splits(spark, files):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    try:
        assert spark.read.text(files[0]).rdd.getNumPartitions() > 4
        rows = read_aligned(spark, *files).orderBy("line_no").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert [r["line_no"] for r in rows] == list(range(500))
    assert [(r["source"], r["target"], r["score"]) for r in rows] == [
        (s.strip(), t, v) for s, t, v in PAIRS
    ]


ENDS = ["\n", "\r\n", "\r"]


@pytest.mark.parametrize("range_bytes, stride, block", [(7, 1, 2), (64, 3, 5), (1000, 10, 64), (1 << 20, 1000, 16384)])
def test_files_side_by_side_like_the_text_reader(spark, tmp_path, range_bytes, stride, block):
    draw = random.Random(range_bytes)
    word = lambda: draw.choice(["", "a", "数据 b", " नम ", "x" * 30, "\u0085 é"])
    total, paths = 150, []
    for side in ("left", "right side"):
        folder = tmp_path / side
        folder.mkdir()
        left = total
        for part, n in enumerate([40, 0, 1, 60, 49]):
            left -= n
            lines = [word() for _ in range(n)]
            ends = [draw.choice(ENDS) for _ in range(n)]
            # "\r" before an empty line that ends with "\n" would be one end, not two
            body = "".join(a + ("\n" if e == "\r" and nxt == "" else e) for a, e, nxt in zip(lines, ends, [*lines[1:], "z"]))
            (folder / f"part-{part}").write_bytes((b"\xef\xbb\xbf" if part == 3 else b"") + body.encode() + (b"\xff open" if part == 4 else b""))
        (folder / "_SUCCESS").write_bytes(b"no line")
        paths.append(str(folder))
    files = {name: line_index.list_files(spark, path) for name, path in zip(("a", "b c"), paths)}
    zipped, lengths = line_index.zip_files(spark, files, range_bytes, stride, block)
    wanted = [[r["value"] for r in read_lines(spark, path)[0].orderBy("line_no").collect()] for path in paths]
    assert lengths == {"a": len(wanted[0]), "b c": len(wanted[1])} and len(wanted[0]) == total + 1
    rows = zipped.orderBy("line_no").collect()
    assert [r["line_no"] for r in rows] == list(range(total + 1))
    assert [r["a"] for r in rows] == wanted[0] and [r["b c"] for r in rows] == wanted[1]
    plan = zipped._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Window" not in plan


def test_lines_and_their_starts_in_small_reads(monkeypatch):
    draw = random.Random(8)
    for size in (1, 2, 5, 64):
        monkeypatch.setattr(line_index, "READ_BYTES", size)
        for _ in range(60):
            body = "".join(draw.choice(["a", "é", "\n", "\r", "\r\n", "数"]) for _ in range(draw.randint(0, 25))).encode()
            lines = line_index.LINE_END.split(body)
            lines = lines if lines[-1] else lines[:-1]
            assert list(line_index.lines_at(pa.BufferReader(body), 0)) == lines
            starts = []
            for low in range(0, len(body), size):
                before = max(low - 1, 0)
                data = np.frombuffer(body[before : low + size], dtype=np.uint8)
                starts += (line_index.line_starts(data, low == 0) + 1 + before).tolist()
            assert len(starts) == len(lines)
            for number, start in enumerate(starts):
                assert list(line_index.lines_at(pa.BufferReader(body), start)) == lines[number:]


def test_a_long_line_and_sides_without_lines(spark, tmp_path):
    long = "y" * 3_000_000
    (tmp_path / "a").write_text(f"{long}\nend")
    (tmp_path / "b").write_text("1\n2\n")
    (tmp_path / "none").write_text("")
    files = {n: line_index.list_files(spark, str(tmp_path / n)) for n in ("a", "b", "none")}
    zipped, lengths = line_index.zip_files(spark, files, 1 << 20)
    assert lengths == {"a": 2, "b": 2, "none": 0}
    assert [tuple(r) for r in zipped.orderBy("line_no").collect()] == [(0, long, "1", None), (1, "end", "2", None)]
    nothing = read_aligned(spark, str(tmp_path / "none"), str(tmp_path / "none"))
    assert nothing.columns == ["line_no", "source", "target"] and nothing.count() == 0


def test_compressed_sides_are_joined(spark, tmp_path):
    made = spark.createDataFrame([(i, f"line {i}") for i in range(50)], "i int, value string").orderBy("i").select("value")
    made.write.text(str(tmp_path / "packed"), compression="gzip")
    made.write.text(str(tmp_path / "plain"))
    rows = read_aligned(spark, str(tmp_path / "packed"), str(tmp_path / "plain")).collect()
    assert len(rows) == 50 and all(r["source"] == r["target"] == f"line {r['line_no']}" for r in rows)


def test_parts_are_read_in_name_order(spark, tmp_path):
    folder = tmp_path / "parts"
    folder.mkdir()
    # later parts are larger, which must not move them to the front
    for i in range(4):
        _write(folder, f"part-{i}", [f"{i}-{j}" for j in range(10 ** (i % 3) + i)])
    lines, total = read_lines(spark, str(folder))
    expected = [f"{i}-{j}" for i in range(4) for j in range(10 ** (i % 3) + i)]
    assert total == len(expected)
    assert [r["value"] for r in lines.orderBy("line_no").collect()] == expected


def test_unequal_sides_are_an_error(spark, files, tmp_path):
    short = _write(tmp_path, "short", ["1.0"] * 499)
    with pytest.raises(AlignmentError, match="499"):
        read_aligned(spark, files[0], files[1], short)


def test_a_score_that_is_no_number_is_an_error(spark, files, tmp_path):
    bad = _write(tmp_path, "bad", ["1.0"] * 499 + ["x"])
    with pytest.raises(Exception, match="not a score"):
        read_aligned(spark, files[0], files[1], bad).collect()


def test_two_sides_without_scores(spark, files):
    assert read_aligned(spark, files[0], files[1]).columns == ["line_no", "source", "target"]


def test_write_aligned_keeps_order_and_lines(spark, tmp_path):
    df = spark.createDataFrame(
        [(i, f"a\nb {i}", f"t{i}", float(i)) for i in range(300)],
        "line_no long, source string, target string, score double",
    ).repartition(5)
    paths = [str(tmp_path / side) for side in "abc"]
    write_aligned(df, *paths)
    back = read_aligned(spark, *paths).orderBy("line_no").collect()
    assert [tuple(r) for r in back] == [(i, f"a b {i}", f"t{i}", float(i)) for i in range(300)]


def test_scoring_csv(spark, tmp_path):
    pairs = spark.createDataFrame(
        [("1", 'क "ख", ग\nघ', " 你好 "), ("2", "", "再见")], "id string, hindi string, chinese string"
    )
    path = str(tmp_path / "pairs")
    tables.write_table(pairs, path, "csv")
    got = sorted(map(tuple, tables.read_pairs(spark, path).collect()))
    assert got == [("1", 'क "ख", ग\nघ', " 你好 "), ("2", "", "再见")]
    with pytest.raises(ValueError, match="must have"):
        tables.read_pairs(spark, path, target="target")


def test_feature_csv_has_types_and_order(spark, tmp_path):
    made = spark.createDataFrame(
        [(0.1 + 0.2, 3, 1.1)], "length_ratio double, hindi_length int, ccmatrix_score double"
    )
    path = str(tmp_path / "features")
    tables.write_table(made, path, "csv")
    df, names = tables.read_features(spark, path)
    assert names == ["length_ratio", "hindi_length"]
    assert df.dtypes == made.dtypes and df.first() == made.first()
    with pytest.raises(ValueError, match="no target"):
        tables.read_features(spark, path, target="score")
    parquet = str(tmp_path / "features.parquet")
    tables.write_table(made, parquet)
    assert tables.read_features(spark, parquet)[1] == names


def test_params_written_and_by_hand(spark, tmp_path):
    path = str(tmp_path / "params")
    tables.write_params(spark, path, "mlp", {"hidden_dim": 64, "dropout": 0.2}, 0.5)
    stored = tables.read_params(spark, path)
    assert stored["best_params"] == {"hidden_dim": 64, "dropout": 0.2}
    assert (stored["model"], stored["best_cv_rmse"]) == ("mlp", 0.5)
    by_hand = tmp_path / "best.json"
    by_hand.write_text(json.dumps({"model": "mlp", "best_params": {"hidden_dim": 64}, "best_cv_rmse": 0.1}, indent=4))
    assert tables.read_params(spark, str(by_hand))["best_params"] == {"hidden_dim": 64}


def test_metrics_json(spark, tmp_path):
    rows = [(m, k, v) for m in ("a", "b") for k, v in (("rmse", 0.1), ("mae", 0.2), ("r2", 0.3))]
    df = spark.createDataFrame(rows, "model string, metric string, value double")
    path = str(tmp_path / "metrics")
    tables.write_metrics(df, path)
    back = tables.read_metrics(spark, path, ["rmse", "mae", "r2"])
    assert sorted(map(tuple, back.collect())) == sorted(rows)
