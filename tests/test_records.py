"""CSV records with line breaks against the one-task reader, on quotes of every kind, cut into blocks of a few bytes."""


import numpy as np
import pytest
from pyspark.sql import functions as F

from numerant.sources import records
from numerant.sources.tables import read_table


def one_task(spark, path):
    return spark.read.csv(path, header=True, inferSchema=False, quote='"', escape='"', multiLine=True)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def cell(rng):
    kind = rng.integers(0, 9)
    word = "".join(rng.choice(list("ab é,1"), rng.integers(0, 7)))
    plain = word.replace(",", "")
    quoted = word.replace("a", '""').replace("b", "\n") + ("\n" if kind == 2 else "")
    return [plain, f'"{quoted}"', f'"{quoted}"', f'{plain or "x"}"{plain}', f'"{word}"tail', f'"{quoted}"', plain, '""', f' "{plain}'][kind]


def csv_of(seed, rows=40, columns=3, end="\n"):
    rng = np.random.default_rng(seed)
    out = ["c0,c1,c2" if seed % 2 else '"c0","c\n1",c2']
    for _ in range(rows):
        line = ",".join(cell(rng) for _ in range(columns))
        out.append(line if line.strip(", ") else "x,y,z")
    return end.join(out) + end


@pytest.mark.parametrize("block", [5, 90])
@pytest.mark.parametrize("seed", [1, 2, 3])
def test_records_are_those_of_one_task(spark, tmp_path, seed, block):
    path = str(tmp_path / "t.csv")
    with open(path, "w", newline="") as f:
        f.write(csv_of(seed))
    wanted = rows_of(one_task(spark, path))
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(block))
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        assert records._lines(spark, path).select("block").distinct().count() > 1
        found = records.read_records(spark, path)
        assert found.columns == one_task(spark, path).columns
        assert rows_of(found) == wanted
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_several_files_and_other_line_ends(spark, tmp_path):
    folder = tmp_path / "many.csv"
    folder.mkdir()
    for i, end in enumerate(["\n", "\r\n", "\n"]):
        (folder / f"{i}.csv").write_bytes(f'a,b{end}1,"x {i}"{end}{end}2,"y{end}z"{end}3,5" pipe{end}'.encode())
    (folder / "empty.csv").write_bytes(b"")
    found = rows_of(records.read_records(spark, str(folder)))
    assert found == sorted([("1", f"x {i}") for i in range(3)] + [("2", "y\nz"), ("2", "y\r\nz"), ("2", "y\nz")] + [("3", '5" pipe')] * 3, key=str)
    assert read_table(spark, str(folder)).dtypes == [("a", "bigint"), ("b", "string")]


def test_a_quote_that_is_never_closed_takes_the_rest(spark, tmp_path):
    path = str(tmp_path / "t.csv")
    with open(path, "w") as f:
        f.write('a,b\n1,x\n2,"open\n' + "3,y\n" * 50)
    last = lambda rows: [tuple(x.rstrip("\n") for x in r) for r in rows]  # noqa: E731 (the file's last line end is none of the cell's)
    assert rows_of(records.read_records(spark, path)) == last(rows_of(one_task(spark, path)))


def test_stray_quotes_do_not_switch(spark, tmp_path):
    lines = ['5" pipe,x', '"a" b,"c"', '"a ""q"" b",x', 'x,"open', '5" x,"open', '"a"tail,"o""', 'plain', '"', '""', '"""', '"a"",b']
    df = spark.createDataFrame([(x,) for x in lines], "line string")
    got = {r.line: r.o for r in df.select("line", records.opens(F.col("line")).alias("o")).collect()}
    assert got == {x: records.ends_inside(x, False) for x in lines}
    assert [x for x in lines if got[x]] == ['x,"open', '5" x,"open', '"a"tail,"o""', '"', '"""', '"a"",b']
    long = '"' + 'a""' * 100_000
    one = spark.createDataFrame([(long,), (long + '"',), ("x," * 100_000 + '"',)], "line string")
    assert [r[0] for r in one.select(records.opens(F.col("line"))).collect()] == [True, False, True]
