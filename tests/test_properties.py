"""Property tests: the archive splitter and key identity on arbitrary input."""

import hashlib
import json
import random

from hypothesis import given, settings
from hypothesis import strategies as st

from tidepool.functions import keys
from tidepool.schemas import RAW_ARCHIVE_DATA
from tidepool.sources.archive import split_records

_text = st.text(alphabet=st.characters(min_codepoint=32, max_codepoint=0x2FFF), max_size=20) | \
    st.sampled_from(['{', '}', '"', '\\', '}{', '{"a": 1}', '\\"}'])
_obj = st.dictionaries(st.text(max_size=5), st.one_of(_text, st.integers(), st.none(),
                                                       st.lists(_text, max_size=3)), max_size=4)


def test_split_records_loses_none(spark):
    """Every whole record comes back, whatever stands behind it."""
    rnd = random.Random(3)
    texts = ["", "a", "{", "}", '"', "\\", "}{", '{"a": 1}', '\\"}', "é", '{"source": "x", "asset_class": 1}']
    between = ["", " ", "junk", "}", '"', '{"source": "cut', '{"source": "cut", "asset_class": "x", "hea', "[1", "{}"]
    lines, want = [], {}
    for i in range(400):
        recs = [(rnd.choice(texts), {rnd.choice(texts): rnd.choice(texts)}, rnd.choice(between))
                for _ in range(rnd.randint(0, 5))]
        want[i] = [(s, o) for s, o, _ in recs]
        lines.append((i, "".join(json.dumps({"source": s, "asset_class": "x", "headline": json.dumps(o)},
                                            ensure_ascii=False) + after for s, o, after in recs)))
    df = spark.createDataFrame(lines, "i long, value string")
    got = {i: [] for i in want}
    for r in split_records(df, RAW_ARCHIVE_DATA, keep=["i"]).collect():
        if r["_corrupt_record"] is None and r["headline"] is not None:
            got[r["i"]].append((r["source"], json.loads(r["headline"])))
    assert {i: sorted(map(str, v)) for i, v in got.items()} == {i: sorted(map(str, v)) for i, v in want.items()}


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(_text, _text), min_size=1, max_size=30))
def test_bar_key_matches_python_for_any_text(spark, rows):
    df = spark.createDataFrame(rows, "s string, d string")
    got = [r[0] for r in df.select(keys.bar_key("s", "d")).collect()]
    want = [hashlib.sha256(f"{s}|{d}".encode()).hexdigest()[:16] for s, d in rows]
    assert got == want
