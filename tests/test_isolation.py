"""Files that cannot be read are left out and reported, the others are loaded."""

import glob
import os

import pytest

from barloom.schemas import RAW
from barloom.sources.prices import read_isolated
from barloom.sources.star_bars import raw_prices

SF = "/root/testdata/sf0.001"


@pytest.fixture
def landed(spark, tmp_path):
    rows = raw_prices(spark, SF)
    for number in range(3):
        part = rows.filter(f"pmod(xxhash64(symbol, date), 3) = {number}").coalesce(1)
        part.write.parquet(str(tmp_path / f"part={number}"))
    files = [glob.glob(str(tmp_path / f"part={n}" / "*.parquet"))[0] for n in range(3)]
    return str(tmp_path), files, [spark.read.parquet(f).count() for f in files]


def names(rejected):
    return {(os.path.basename(r.file), r.bytes, r.reason) for r in rejected.collect()}


@pytest.mark.parametrize("every_page", [False, True])
def test_cut_and_foreign_files(spark, landed, every_page):
    folder, files, counts = landed
    rows, rejected = read_isolated(spark, RAW, folder, every_page=every_page)
    assert rows.count() == sum(counts) and rejected.isEmpty()
    assert rows.schema.fieldNames()[: len(RAW.fields)] == RAW.fieldNames()
    with open(files[1], "rb+") as file:
        file.truncate(os.path.getsize(files[1]) // 2)
    foreign = os.path.join(folder, "part=2", "foreign.parquet")
    with open(foreign, "w") as file:
        file.write("not a table")
    open(os.path.join(folder, "part=0", "nothing.parquet"), "w").close()
    rows, rejected = read_isolated(spark, RAW, folder, every_page=every_page)
    assert rows.select(*RAW.fieldNames()).count() == counts[0] + counts[2]
    cut = (os.path.basename(files[1]), os.path.getsize(files[1]), "no readable rows")
    found = names(rejected)
    assert {cut, ("foreign.parquet", 11, "no readable rows")} <= found
    assert len(found) <= 3


def test_damage_inside_a_file(spark, landed):
    folder, files, counts = landed
    with open(files[0], "rb+") as file:
        file.seek(200)
        file.write(b"\xff" * 4000)
    rows, rejected = read_isolated(spark, RAW, folder, every_page=True)
    assert names(rejected) == {
        (os.path.basename(files[0]), os.path.getsize(files[0]), "unreadable pages")
    }
    assert rows.count() == counts[1] + counts[2]
