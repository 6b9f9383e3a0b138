"""F1/F2/F7/F8 row-level rules against plain statements of the rules."""

import random
import re

from pyspark.sql import functions as F

from skein.functions import dims
from skein.functions.predicates import list_relevant, list_relevant_substring, location_match, with_city_targets
from skein.operators.analysis import location_matches, location_pivot

EDGE_LOCATIONS = [None, "", "  ", "!!!", "Kolkata, India", "CALCUTTA", "NYC ", "New York City", "Guatemala",
                  "Ciudad de Guatemala", "Bogotá", "Kolkatastan", "bombay beach", "cdmx"]


def plain_rule(raw, city, exclude_bare=("guatemala",)):
    """The location rule stated plainly: lower/strip, any target as a word or substring."""
    targets = [] if city in exclude_bare else [city]
    targets += [a for a, c in dims.ALIASES.items() if c == city]
    if not isinstance(raw, str):
        return False
    low = raw.lower().strip()
    toks = re.findall(r"\w+", low)
    if not toks:
        return False
    return any(t in toks or t in low for t in targets)


def test_location_match_equals_plain_rule(spark):
    rng = random.Random(7)
    pieces = ["kolkata", "calcutta", "nyc", "new york", "guatemala", "ciudad de guatemala", "bogotá", "mumbai",
              "bombay", " ", ",", "x", "India", "!!", "CDMX", "delhi"]
    strings = EDGE_LOCATIONS + ["".join(rng.choice(pieces) for _ in range(rng.randint(0, 4))) for _ in range(400)]
    rows = [(str(i), s, c) for i, s in enumerate(strings) for c in ["kolkata", "new york", "guatemala", "mexico city", "bogota"]]
    df = spark.createDataFrame(rows, "user_id STRING, location STRING, search_location STRING")
    got = {(r.user_id, r.search_location): r.location_match for r in location_matches(df).collect()}
    for uid, loc, city in rows:
        assert got[(uid, city)] == plain_rule(loc, city), (loc, city)


def test_bare_guatemala_only_in_network_twin(spark):
    df = spark.createDataFrame([("1", "Guatemala", "guatemala")], "user_id STRING, location STRING, search_location STRING")
    assert location_matches(df).first().location_match is False
    assert location_matches(df, exclude_bare=None).first().location_match is True


def test_unknown_city_matches_its_own_name(spark):
    df = spark.createDataFrame([("1", "Lagos, NG", "lagos")], "user_id STRING, location STRING, search_location STRING")
    t = with_city_targets(df, "search_location")
    assert t.select(location_match("location", "targets")).first()[0] is True


def test_pivot_missing_side_is_null(spark):
    df = spark.createDataFrame([("1", "kolkata", True), ("2", "kolkata", True), ("3", "nyc", False)],
                               "user_id STRING, search_location STRING, location_match BOOLEAN")
    rows = {r.location: r for r in location_pivot(df).collect()}
    assert rows["kolkata"].n_false is None and rows["kolkata"].total is None
    assert rows["kolkata"].n_true == 2 and rows["nyc"].n_true is None


def test_list_keywords_token_vs_substring(spark):
    df = spark.createDataFrame([("Repair shops", ""), ("Air Quality", None), ("non profit", ""),
                                ("x", "climate and smog"), ("NGO directory", "")], "name STRING, description STRING")
    tok = [r[0] for r in df.select(list_relevant("name", "description")).collect()]
    sub = [r[0] for r in df.select(list_relevant_substring("name", "description")).collect()]
    assert tok == [False, True, False, True, True]      # "non profit" can never match as a token
    assert sub == [True, True, False, True, True]        # "repair" contains "air"
