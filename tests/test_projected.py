"""The projected scan opens the predicate's folders and no other."""

import gzip
import json
import os

from pyspark.sql import functions as F

from tidepool import schemas as S
from tidepool.sources.projected import read_projected, read_projected_json


def put(base, symbol, day, hour, lines, name="data.jsonl"):
    d = f"{base}/source=finnhub/asset_class=equity/symbol={symbol}/year=2026/month=06/day={day:02d}/hour={hour:02d}"
    os.makedirs(d, exist_ok=True)
    data = "\n".join(lines).encode() + b"\n"
    with open(f"{d}/{name}", "wb") as f:
        f.write(gzip.compress(data) if name.endswith(".gz") else data)


def article(key):
    return json.dumps({"source": "finnhub", "asset_class": "equity", "dedup_key": key, "headline": "h", "datetime": 5})


def keys(df):
    return sorted(r.dedup_key for r in read_projected_json(df).where(F.col(S.CORRUPT_COL).isNull()).collect())


def test_only_folders_of_the_predicate_are_opened(spark, tmp_path):
    base = str(tmp_path)
    put(base, "A", 1, 3, [article("a1"), "bad {"])
    put(base, "A", 1, 4, [article("a2")], "x.json.gz")
    put(base, "A", 2, 0, [article("a3")])
    put(base, "B", 1, 3, [article("b1")])
    put(base, "C", 1, 3, [article("outside the enumeration")])
    put(base, "A", 9, 0, [article("outside the range")])
    table = read_projected(spark, base, ["A", "B", "NONE"], "2026-06-01 00:00:00", "2026-06-03 23:00:00", tasks=5)
    assert keys(table) == ["a1", "a2", "a3", "b1"]  # missing folders are empty
    assert [r[0] for r in read_projected_json(table).where(f"{S.CORRUPT_COL} is not null").select(S.CORRUPT_COL)
            .collect()] == ["bad {"]
    # a file that can't be read shows which folders are opened
    poison = f"{base}/source=finnhub/asset_class=equity/symbol=B/year=2026/month=06/day=02/hour=07"
    os.makedirs(poison)
    with open(f"{poison}/broken.gz", "wb") as f:
        f.write(b"no gzip")
    assert keys(table.where("symbol = 'A'")) == ["a1", "a2", "a3"]
    assert keys(table.where("day = 1")) == ["a1", "a2", "b1"]
    assert keys(table.where("symbol in ('A', 'B') and day >= 1 and day < 2 and hour <= 3")) == ["a1", "b1"]
    assert keys(table.where("symbol = 'NONE'")) == [] == keys(table.where("year = 1999"))
    try:
        keys(table.where("symbol = 'B'"))
        raise AssertionError("the broken file was not opened")
    except Exception as e:
        assert "gzip" in str(e).lower()


def test_tasks_are_bounded_and_days_have_no_hour(spark, tmp_path):
    base, template = str(tmp_path), "s={symbol}/{year}-{month}-{day}/"
    os.makedirs(f"{base}/s=A/2026-06-01")
    with open(f"{base}/s=A/2026-06-01/f.json", "w") as f:
        f.write("one\ntwo")
    t = read_projected(spark, base, ["A"], "2024-01-01 00:00:00", "2030-12-31 00:00:00", "day", template, tasks=7)
    assert t.rdd.getNumPartitions() <= 7
    assert sorted((r.value, r.year, r.month, r.day, r.hour) for r in t.collect()) == [
        ("one", 2026, 6, 1, None), ("two", 2026, 6, 1, None)]
