"""Property tests: native expressions against independent Python matchers."""

import re

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tickerpulse.constants import TICKERS
from tickerpulse.functions.entities import extract_hashtags, identify_tickers

ALT = "|".join(sorted(TICKERS, key=len, reverse=True))
SYMBOL = re.compile(r"[$#＃](" + ALT + r")(?![A-Za-z|])", re.IGNORECASE)

# symbol-heavy alphabet (the four letters Python folds to ASCII are left out)
PIECES = st.sampled_from(["$", "#", "＃", "|", " ", "_", "-", "1", "é", "ß", "Ω", "x", "L", "S",
                          "AAPL", "aapl", "GOOG", "goog", "MU", "mu", "EBAY", "META", "ZM", "\n"])
TEXTS = st.lists(st.lists(PIECES, max_size=16).map("".join), min_size=1, max_size=40)


def py_identify(text):
    return sorted({m.group(1).upper() for m in SYMBOL.finditer(text)})


def py_tags(text):
    return [t.upper() for t in re.findall(r"#(\w+)", text)] if text else []


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(TEXTS)
def test_identify_and_tags_match_python(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string")
    rows = df.select("i", identify_tickers("text", None, TICKERS).alias("t"),
                     extract_hashtags("text").alias("g")).collect()
    for r in rows:
        t = texts[r["i"]]
        assert r["t"] == py_identify(t), t
        assert r["g"] == py_tags(t), t
