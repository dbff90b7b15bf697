"""Records of delimited files, block by block, against Spark's reader of whole files."""

import random

import numpy as np
import pytest

from pressmill.session import with_settings
from pressmill.sources import records
from pressmill.sources import tables as sources

NAMES = ["id", "type", "content"]
SMALL = {"spark.sql.files.maxPartitionBytes": "997", "spark.sql.files.openCostInBytes": "0"}


def whole_files(spark, path, names=NAMES, **options):
    """The reader that takes a file as one task; too many fields show in one more column."""
    schema = ", ".join(f"`{n}` string" for n in [*names, "_extra"])
    table = spark.read.schema(schema).options(**sources.csv_options(True, header=False, **options)).csv(path)
    return table.where("_extra is null").drop("_extra")


def some_file(seed, rows=120):
    rng = random.Random(seed)
    pieces = ["word", "Été", "日本", ",", "\n", '""', "\n\n", " ", "x, y", ";", "\t", "a\nb"]
    loose = ["word", "", "5\"", " \"q\" ", "plain text", "Été", "it's"]
    lines = []
    for i in range(rows):
        fields = [str(i), rng.choice(["fake", '"reliable"', ""])]
        kind = rng.random()
        if kind < 0.6:
            fields.append('"' + "".join(rng.choice(pieces) for _ in range(rng.randint(0, 40))) + '"')
        elif kind < 0.8:
            fields.append(rng.choice(loose))
        elif kind < 0.9:
            fields = fields[:rng.randint(1, 2)]
        else:
            fields += ['"a\nb"', rng.choice(["surplus", '"one, more"'])]
        lines.append(",".join(fields))
        if rng.random() < 0.05:
            lines.append("")
    return "\n".join(lines) + ("\n" if seed % 2 else "")


@pytest.mark.parametrize("seed", range(4))
def test_equals_reader_of_whole_files(spark, tmp_path, seed):
    path = tmp_path / "a.csv"
    path.write_bytes(some_file(seed).encode())
    with with_settings(spark, SMALL):
        found = sources.read_articles_csv(spark, str(path), header=NAMES)
        ours = sorted(map(tuple, found.collect()), key=str)
        tasks = records.read_records(spark, str(path)).select("record").rdd.getNumPartitions()
    assert ours == sorted(map(tuple, whole_files(spark, str(path)).collect()), key=str)
    assert tasks > 3


def test_one_field_over_many_blocks(spark, tmp_path):
    """Records longer than a block, one of them never closed, in several files."""
    long = "line, with \"\"quotes\"\"\n" * 400
    (tmp_path / "a.csv").write_text(f'1,x,"{long}"\n2,y,"{long}"\n3,z,end\n')
    (tmp_path / "b.csv").write_text(f'4,x,plain\n5,y,"{long}')
    (tmp_path / "c.csv").write_text("")
    with with_settings(spark, SMALL):
        found = {r["id"]: r["content"] for r in sources.read_articles_csv(spark, str(tmp_path), header=NAMES).collect()}
    text = long.replace('""', '"')
    assert found["1"] == text and found["2"] == text and found["3"] == "end" and found["4"] == "plain"
    assert found["5"].strip() == text.strip() and len(found) == 5


def test_surplus_empty_fields_are_seen(spark, tmp_path):
    path = tmp_path / "a.csv"
    path.write_text('id,type,content\n1,fake,one\n2,fake,two,\n3,fake,"a,\nb",""\n4,fake\n5,"x,y","a\nb"\n')
    assert sorted(r["id"] for r in sources.read_articles_csv(spark, str(path)).collect()) == ["1", "4", "5"]


def test_line_ends_marks_and_bytes(spark, tmp_path):
    path = tmp_path / "a.csv"
    path.write_bytes(b'\xef\xbb\xbfid,type,content\r\n1,fake,"a\r\nb"\r\n\r\n2,h\xffate,c\r\n')
    rows = sorted(map(tuple, sources.read_articles_csv(spark, str(path), header=NAMES).collect()))
    assert rows == [("1", "fake", "a\r\nb"), ("2", "hate", "c")]
    assert [tuple(r) for r in sources.read_articles_csv(spark, str(path), ["content", "id"]).collect()] \
        == [("a\r\nb", "1"), ("c", "2")]


@pytest.mark.parametrize("seed", range(20))
def test_state_of_any_cut(seed):
    """Read on from any line in the state that was found there, a file gives the same records."""
    data = np.frombuffer((some_file(seed, 25).rstrip("\n") + "\n").encode(), np.uint8)
    ends, seps, _ = records.cut(data, False, 44)
    for at in (np.flatnonzero(data == 10) + 1).tolist()[:-1]:
        first, some, inside = records.cut(data[:at], False, 44)
        second, more, _ = records.cut(data[at:], inside, 44)
        assert np.append(first, second + at).tolist() == ends.tolist()
        assert np.append(some, more + at).tolist() == seps.tolist()


def test_windows_hold_no_text(spark, tmp_path, monkeypatch):
    """All blocks of a file meet in one task, so only their states may go there."""
    from pressmill.sources import records

    plans = []
    written = records.materialize

    def kept(df, name):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return written(df, name)

    monkeypatch.setattr(records, "materialize", kept)
    (tmp_path / "a.csv").write_text('1,"a\nb"\n2,c\n')
    assert records.read_records(spark, str(tmp_path / "a.csv")).count() == 2
    windows = [line for plan in plans for line in plan.splitlines() if "Window [" in line]
    below = [line for line in plans[-1].split("Window [")[-1].splitlines() if "Relation" not in line]
    assert windows and not any(text in line for line in below for text in ("head_in", "tail_in", "tail_out"))


def test_one_file_is_written_by_a_task_of_its_own(spark, sf_dir, monkeypatch):
    """The task that writes the single file does no joins and sorts of the rows before it."""
    from pressmill.plans import io_queries

    calls = []
    for name in ("coalesce", "repartition"):
        monkeypatch.setattr(type(spark.range(1)), name,
                            lambda self, *a, f=getattr(type(spark.range(1)), name), n=name: calls.append((n, a)) or f(self, *a))
    io_queries.csv_one_file(spark, sf_dir)
    assert ("coalesce", (1,)) not in calls and ("repartition", (1,)) in calls
