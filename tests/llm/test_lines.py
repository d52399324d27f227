"""Line deduplication against a plain version."""

import random

from chartspark.llm import lines


def expected(rows, size=3):
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0] or 0, i))
    seen, gone = set(), {i: set() for i in order}
    for i in order:
        split = (rows[i][1] or "").split("\n")
        for p in range(len(split) - size + 1):
            window = tuple(split[p : p + size])
            if window in seen:
                gone[i].update(range(p, p + size))
            seen.add(window)
    out = []
    for i, (key, text) in enumerate(rows):
        split = (text or "").split("\n")
        out.append((key, "\n".join(x for p, x in enumerate(split) if p not in gone[i]), len(split), sorted(gone[i])))
    return sorted(out, key=repr)


def found(spark, tmp_path, rows):
    path = str(tmp_path / "docs")
    frame = spark.createDataFrame([(k, t, 0) for k, t in rows], "doc_id long, text string, pos int")
    frame.coalesce(1).write.parquet(path)
    result = lines.line_dedup(spark.read.parquet(path)).collect()
    return sorted(((r.key, r.text, r.n_lines, list(r.removed)) for r in result), key=repr)


def test_against_a_plain_version(spark, tmp_path):
    pick = random.Random(2)
    rows = [
        (pick.choice([None, *range(40)]), pick.choice([None, "\n".join(pick.choices(["a", "b", "c", "", "é"], k=pick.randrange(12)))]))
        for _ in range(150)
    ]
    assert found(spark, tmp_path, rows) == expected(rows)


def test_a_passage_is_removed_as_a_whole(spark, tmp_path):
    passage = "\n".join(f"line {i}" for i in range(6))
    rows = [(1, f"own\n{passage}\nend"), (2, f"other\n{passage}"), (3, "line 1\nline 2"), (4, "x\n" * 5)]
    assert found(spark, tmp_path, rows) == expected(rows)
    assert expected(rows)[1] == (2, "other", 7, [1, 2, 3, 4, 5, 6])


def test_all_lines_removed_and_no_documents(spark, tmp_path):
    rows = [(1, "a\nb\nc"), (2, "a\nb\nc"), (3, ""), (4, None), (5, "a\nb")]
    assert found(spark, tmp_path, rows) == expected(rows)
    assert found(spark, tmp_path / "none", []) == []


def test_a_hot_passage(spark, tmp_path):
    rows = [(i, "p\nq\nr\ns" if i % 3 else f"{i}\nq\nr") for i in range(600)]
    assert found(spark, tmp_path, rows) == expected(rows)


def test_files_are_split_in_another_way_later(spark, tmp_path, other_splits):
    """The rows that are cut are those whose windows were found, however the second read is split."""
    passage = "p\nq\nr"
    rows = [(i, f"own {i}\n{passage}" if i % 3 else f"{i}\na {i}\nb {i}\nc {i}") for i in range(160)]
    frame = spark.createDataFrame([(k, t, 0) for k, t in rows], "doc_id long, text string, pos int")
    frame.repartitionByRange(16, "doc_id").write.parquet(str(tmp_path / "docs"))
    result = lines.line_dedup(spark.read.parquet(str(tmp_path / "docs")))
    other_splits()
    got = sorted(((r.key, r.text, r.n_lines, list(r.removed)) for r in result.collect()), key=repr)
    assert got == expected(rows)
