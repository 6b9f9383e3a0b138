"""URL filters: host/path rules first, mined token rules for the rest.

Spark's FP-growth mines combinations of URL tokens that go along with a bad label. A combination
becomes a block rule if its support, confidence and lift reach the given bounds and no part of it is
as sure by itself. An inverted index (rarest token -> rules) matches rules against every URL.

Items that lie on the same labelled pages (a site's host, its labels, the segments that all its pages
share) are one item for the mining, any of them standing for it: a rule is found once and not once for
every choice among them, and the sets do not multiply with the length of a site's URLs. This loses no
rule and no match.

Scale: a URL gives an item for every label of its host, path segment, word of a segment and query key,
beside scheme, host, top-level domain, last two labels, first label, depth and fragment. Covers are
compared by aggregated hashes; sets and rules stay distributed. Up to ``BROADCAST_RULES`` rules are
broadcast as the index and matched in one pass without a shuffle; more are joined on their rarest item,
with the same result. Labels are joined to pages on their ids, one label per id.

Defined results: a null URL or one without ``://`` has an empty host and path, no rule, and is
allowed unless its items match a mined rule. An id labelled more than once is bad if any of its
labels is. A null in quality or toxic counts as not bad; null ids take no part in the mining. With
no labelled page there are no mined rules. Repeated rows are judged each by itself.
"""

from __future__ import annotations

import math
import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skein.llm import common

#: Share of the labelled pages that a combination must be found on, beside the absolute ``MIN_COUNT``.
MIN_SUPPORT = 0.0
MIN_CONFIDENCE = 0.6
MIN_LIFT = 1.5
#: Labelled pages that a combination must be found on, however few there are.
MIN_COUNT = 20
#: (verdict, rule): a rule fits its host and all subdomains where the path starts with the rule's.
RULES = [("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/")]
BAD = "label=bad"
#: Rules (and items in them) that are sent to all workers at once: some 20 MB.
BROADCAST_RULES = 1 << 16

_URL = r"(?s)://([^/?#]*)([^?#]*)"


def host_and_path(url: Column) -> tuple[Column, Column]:
    text = F.coalesce(url.cast("string"), F.lit(""))
    host = F.translate(F.regexp_extract(text, _URL, 1), common.UPPER, common.UPPER.lower())
    return host, F.regexp_extract(text, _URL, 2)


def rule_of(host: Column, path: Column, rules=RULES) -> Column:
    """struct(rule, verdict) of the longest rule that fits, nulls if none does."""
    none = F.struct(F.lit(None).cast("string").alias("rule"), F.lit(None).cast("string").alias("verdict"))
    out = none
    for verdict, rule in sorted(rules, key=lambda r: len(r[1])):
        rule_host, _, rest = rule.partition("/")
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith("/" + rest)
        out = F.when(fits, F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def url_items(url: str | None) -> list[str]:
    """The items of a URL, each once: scheme, host and all its labels, all path segments and their words, all
    query keys, depth, and whether there is a fragment."""
    if not url or "://" not in url:
        return ["form=none"]
    scheme, _, rest = url.partition("://")
    end = min((i for i in map(rest.find, "/?#") if i >= 0), default=len(rest))
    host, rest = rest[:end].lower(), rest[end:]
    rest, _, fragment = rest.partition("#")
    path, _, query = rest.partition("?")
    labels = host.split(".")
    parts = [p for p in path.lower().split("/") if p]
    items = [f"scheme={scheme.lower()}", f"host={host}", f"tld={labels[-1]}", f"first={labels[0]}",
             f"depth={len(parts)}"]
    if len(labels) > 1:
        items.append("domain=" + ".".join(labels[-2:]))
    items += [f"part={x}" for x in labels[:-1]]
    items += [f"path{i}={re.sub(r'[0-9]+', '0', p)}" for i, p in enumerate(parts, 1)]
    # numbers are one word, as in the segments
    items += [f"word={re.sub(r'[0-9]+', '0', w)}" for p in parts for w in re.split(r"[\W_]+", p) if w]
    items += [f"key={q.partition('=')[0]}" for q in query.lower().split("&") if q]
    if fragment:
        items.append("fragment=yes")
    return list(dict.fromkeys(items))


def _baskets(urls: DataFrame) -> DataFrame:
    """(row, items, bad) of the (url, bad) rows, stored."""
    def items(batches):
        for batch in batches:
            rows = [url_items(u) for u in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.list_(pa.string())), batch.column(1)], ["items", "bad"])

    return common.materialise(urls.select("url", F.coalesce("bad", F.lit(False)).alias("bad"))
                              .mapInArrow(items, "items array<string>, bad boolean")
                              .select(F.monotonically_increasing_id().alias("row"), "items", "bad"))


def _members(baskets: DataFrame, least: int) -> DataFrame:
    """(item, cover, n): every item of ``least`` baskets and more, and the smallest item with the same baskets."""
    of = (baskets.select("row", F.explode("items").alias("item")).groupBy("item")
          .agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("row")).alias("x"),
               F.bit_xor(F.xxhash64("row", F.lit("cover"))).alias("y")).filter(F.col("n") >= least))
    names = of.groupBy("n", "x", "y").agg(F.min("item").alias("cover"))
    return common.materialise(of.join(names, ["n", "x", "y"]).select("item", "cover", "n"))


def mine_rules(urls: DataFrame, min_support: float = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE,
               min_lift: float = MIN_LIFT, min_count: int = MIN_COUNT) -> tuple[DataFrame, DataFrame]:
    """Block rules (covers, rarest, support, confidence) and members (item, cover, n) from (url, bad) rows.

    A rule fits a URL if each of its covers has a member among the URL's items; ``rarest`` is the cover on
    the fewest labelled pages.
    """
    from pyspark.ml.fpm import FPGrowth

    baskets = _baskets(urls)
    total, bad = baskets.agg(F.count(F.lit(1)), F.count_if("bad")).first()
    support = min(1.0, max(min_support, min_count / max(total, 1)))
    members = _members(baskets, max(1, math.ceil(support * total)))
    if not bad:
        return urls.sparkSession.createDataFrame([], "covers array<string>, rarest string, support double, confidence double"), members
    # Items under the support are in no frequent set; a basket left without any is one with an empty list.
    covered = (baskets.select("row", "bad", F.explode_outer("items").alias("item")).join(members, "item", "left")
               .groupBy("row", "bad").agg(F.collect_set("cover").alias("items")))
    covered = common.materialise(covered.select(
        F.when(F.col("bad"), F.array_append("items", F.lit(BAD))).otherwise(F.col("items")).alias("items")))
    sets = FPGrowth(itemsCol="items", minSupport=support, minConfidence=min_confidence).fit(covered).freqItemsets
    with_bad = F.array_contains("items", BAD)
    alone = sets.filter(~with_bad).select(F.array_sort("items").alias("covers"), F.col("freq").alias("n"))
    both = (sets.filter(with_bad & (F.size("items") > 1))
            .select(F.array_sort(F.array_remove("items", BAD)).alias("covers"), F.col("freq").alias("n_bad")))
    sure = F.col("n_bad") / F.col("n")
    # A part that is as sure as a set within the bounds is within them too, so the others can go at once.
    able = both.join(alone, "covers").filter((sure >= min_confidence) & (sure >= min_lift * bad / total) & (sure > bad / total))
    counts = members.filter("item = cover").select(F.col("cover").alias("one"), F.col("n").alias("of_one"))
    able = common.materialise(
        able.withColumn("one", F.explode("covers")).join(counts, "one").groupBy("covers", "n_bad", "n")
        .agg(F.min(F.struct("of_one", "one"))["one"].alias("rarest"))
        .select("covers", "rarest", (F.col("n_bad") / total).alias("support"), sure.alias("confidence")))
    part = able.select(F.col("covers").alias("part"), F.col("rarest").alias("one"), F.col("confidence").alias("of_part"))
    beaten = (able.withColumn("one", F.explode("covers")).join(part, "one")
              .filter((F.size("part") < F.size("covers")) & (F.col("of_part") >= F.col("confidence"))
                      & (F.size(F.array_except("part", "covers")) == 0)).select("covers").distinct())
    return common.materialise(able.join(beaten, "covers", "left_anti")), members


def _match_by_index(narrow: DataFrame, rules, members, kind: str) -> DataFrame:
    """Matches with the whole index in each worker."""
    cover_of: dict[str, str] = {r["item"]: r["cover"] for r in members}
    index: dict[str, list[tuple[list[str], float]]] = {}
    for r in rules:
        index.setdefault(r["rarest"], []).append((r["covers"], r["confidence"]))

    def match(batches):
        for batch in batches:
            out = []
            for url in batch.column(1).to_pylist():
                name: dict[str, str] = {}  # cover -> its smallest member among the URL's items
                for item in sorted(url_items(url), reverse=True):
                    if item in cover_of:
                        name[cover_of[item]] = item
                hits = [(-sure, sorted(name[c] for c in covers)) for one in name for covers, sure in index.get(one, ())
                        if all(c in name for c in covers)]
                out.append(" & ".join(min(hits)[1]) if hits else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(out, pa.string())], ["page_id", "url", "mined"])

    return narrow.mapInArrow(match, f"page_id {kind}, url string, mined string")


def _match_by_join(narrow: DataFrame, rules: DataFrame, members: DataFrame, kind: str) -> DataFrame:
    """The same matches by joins: items to covers, rarest covers to rules, all covers of a rule within the URL's."""
    def items(batches):
        for batch in batches:
            rows = [url_items(u) for u in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(rows, pa.list_(pa.string()))],
                                             ["row", "page_id", "url", "items"])

    pages = common.materialise(narrow.select(F.monotonically_increasing_id().alias("row"), "page_id", "url"))
    found = pages.mapInArrow(items, f"row long, page_id {kind}, url string, items array<string>")
    names = (found.select("row", F.explode("items").alias("item")).join(members.select("item", "cover"), "item")
             .groupBy("row", "cover").agg(F.min("item").alias("name")))
    own = names.groupBy("row").agg(F.map_from_entries(F.collect_list(F.struct("cover", "name"))).alias("name"))
    hits = (own.withColumn("rarest", F.explode(F.map_keys("name"))).join(rules, "rarest")
            .filter(F.forall("covers", lambda c: F.map_contains_key("name", c)))
            .select("row", (-F.col("confidence")).alias("sure"),
                    F.array_sort(F.transform("covers", lambda c: F.col("name")[c])).alias("words"))
            .groupBy("row").agg(F.array_join(F.min(F.struct("sure", "words"))["words"], " & ").alias("mined")))
    return pages.join(hits, "row", "left").select("page_id", "url", "mined")


def url_filter(pages: DataFrame, labels: DataFrame, id_col: str = "page_id", url_col: str = "url",
               label_id: str = "doc_id", rules=RULES, min_support: float = MIN_SUPPORT,
               min_confidence: float = MIN_CONFIDENCE, min_lift: float = MIN_LIFT,
               min_count: int = MIN_COUNT, broadcast_rules: int = BROADCAST_RULES) -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict, mined (the mined rule that matched)."""
    common.prepare(pages.sparkSession)
    narrow = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).cast("string").alias("url"))
    marks = (labels.select(F.col(label_id).alias("page_id"), F.coalesce(
        (F.col("quality") == 0) | F.coalesce(F.col("toxic") == 1, F.lit(False)), F.col("toxic") == 1,
        F.lit(False)).alias("bad")).filter(F.col("page_id").isNotNull())
        .groupBy("page_id").agg(F.bool_or("bad").alias("bad")))
    mined, members = mine_rules(narrow.join(marks, "page_id"), min_support, min_confidence, min_lift, min_count)
    used = members.join(mined.select(F.explode("covers").alias("cover")).distinct(), "cover", "left_semi")
    kind = narrow.schema["page_id"].dataType.simpleString()
    if max(mined.count(), used.count()) <= broadcast_rules:
        matched = _match_by_index(narrow, mined.collect(), used.collect(), kind)
    else:
        matched = _match_by_join(narrow, mined, used, kind)
    host, path = host_and_path(F.col("url"))
    judged = matched.select("page_id", host.alias("host"), path.alias("path"), "mined")
    judged = judged.withColumn("r", rule_of(F.col("host"), F.col("path"), rules))
    verdict = F.coalesce("r.verdict", F.when(F.col("mined").isNotNull(), F.lit("block")).otherwise(F.lit("allow")))
    return judged.select("page_id", "host", "path", F.col("r.rule").alias("rule"), verdict.alias("verdict"), "mined")


def op1_url_filter(spark, sf_dir: str) -> DataFrame:
    return url_filter(common.table(spark, sf_dir, "pages"), common.table(spark, sf_dir, "labels"))
