"""Itemsets and association rules."""

from __future__ import annotations

from pyspark.sql import functions as F

from ...functions.exprs import round_all
from ...operators import encode, rules
from ...session import cut_lineage
from ..registry import query
from .profile import TRX, trx

_COLS = ("flag", "status", "disc", "qty", "target")
_TAGS = ", ".join(f"CASE WHEN {c} IS NOT NULL THEN '{c}=' || {c} END" for c in sorted(_COLS))


def baskets(spark, d):
    return encode.one_hot_items(trx(spark, d), _COLS).select("segment", "items")


def itemset_sql(group="", min_support=0.05):
    """All item combinations of the transaction columns by CUBE; an exact count of every itemset."""
    g = f"{group}, " if group else ""
    on = f"WHERE c.{group} = n.{group}" if group else ""
    size = f"(SELECT {g}COUNT(*) AS n FROM trx {'GROUP BY ' + group if group else ''})"
    key = f"c.{group}, " if group else ""
    grouping = f"GROUP BY {group}, CUBE({', '.join(_COLS)})" if group else f"GROUP BY CUBE({', '.join(_COLS)})"
    return f""", c AS MATERIALIZED (SELECT {g}{', '.join(_COLS)}, COUNT(*) AS freq FROM trx {grouping}),
    fi AS (SELECT {key}list_filter([{_TAGS}], lambda x: x IS NOT NULL) AS items, freq, freq / n AS support FROM c, {size} n {on}),
    f AS MATERIALIZED (SELECT *, array_to_string(items, ', ') AS k FROM fi WHERE len(items) > 0 AND support >= {min_support})"""


_SPLIT = """, sp AS MATERIALIZED (SELECT *, unnest(range(1, CAST(2 ** len(items) AS BIGINT) - 1)) AS m FROM f WHERE len(items) > 1),
    halves AS (SELECT {g}list_filter(items, lambda x, i: (m >> (i - 1)) & 1 = 1) AS a, list_filter(items, lambda x, i: (m >> (i - 1)) & 1 = 0) AS b, support AS s FROM sp),
    ab AS MATERIALIZED (SELECT *, array_to_string(a, ', ') AS ka, array_to_string(b, ', ') AS kb FROM halves),
    ru AS (SELECT {g2}ab.a AS a, ab.b AS b, x.support AS sa, y.support AS sc, s, s / x.support AS conf, s / x.support / y.support AS lift, s - x.support * y.support AS leverage,
      CASE WHEN s / x.support >= 1 THEN CAST('inf' AS DOUBLE) ELSE (1 - y.support) / (1 - s / x.support) END AS conviction
      FROM ab JOIN f x ON x.k = ab.ka{x} JOIN f y ON y.k = ab.kb{y})"""
_RULES = itemset_sql() + _SPLIT.format(g="", g2="", x="", y="")
_OUT = """array_to_string(a, ', ') AS antecedents, array_to_string(b, ', ') AS consequents, ROUND(s, 6) AS support, ROUND(conf, 6) AS confidence, ROUND(lift, 6) AS lift,
    ROUND(leverage, 6) AS leverage, ROUND(conviction, 4) AS conviction"""


def flat(df, *extra):
    return df.select(
        *extra,
        F.concat_ws(", ", "antecedents").alias("antecedents"),
        F.concat_ws(", ", "consequents").alias("consequents"),
        *[F.round(c, 6).alias(c) for c in ("support", "confidence", "lift", "leverage")],
        F.when(F.col("conviction") == float("inf"), F.col("conviction")).otherwise(F.round("conviction", 4)).alias("conviction"),
    )


@query("frequent_itemsets", TRX + itemset_sql() + "SELECT array_to_string(items, ', ') AS items, freq, ROUND(support, 6) AS support FROM f")
def q_itemsets(spark, d):
    out = rules.frequent_itemsets(baskets(spark, d))
    return round_all(out.select(F.concat_ws(", ", "items").alias("items"), "freq", "support"))


def mined(spark, d, threshold=1.2, **kw):
    return rules.association_rules(cut_lineage(rules.frequent_itemsets(baskets(spark, d))), "lift", threshold, **kw)


@query("association_rules", TRX + _RULES + f"SELECT {_OUT} FROM ru WHERE lift >= 1.2")
def q_rules(spark, d):
    return flat(mined(spark, d))


@query(
    "rule_support_join",
    TRX + _RULES + "SELECT array_to_string(a, ', ') AS antecedents, array_to_string(b, ', ') AS consequents, ROUND(sa, 6) AS antecedent_support, ROUND(sc, 6) AS consequent_support FROM ru",
)
def q_supports(spark, d):
    out = mined(spark, d, 0.0)
    return round_all(out.select(F.concat_ws(", ", "antecedents").alias("antecedents"), F.concat_ws(", ", "consequents").alias("consequents"), "antecedent_support", "consequent_support"))


@query("rules_target_consequent", TRX + _RULES + f"SELECT {_OUT} FROM ru WHERE lift >= 1.1 AND list_contains(b, 'target=yes')")
def q_target_rules(spark, d):
    return flat(mined(spark, d, 1.1, consequent_has="target=yes"))


@query("rules_topn", TRX + _RULES + f"SELECT {_OUT} FROM ru WHERE lift >= 1.2 ORDER BY ROUND(ru.lift, 9) DESC, array_to_string(a, ','), array_to_string(b, ',') LIMIT 20")
def q_top(spark, d):
    return flat(rules.top_rules(mined(spark, d), ["lift"], 20))


@query("rules_involving_item", TRX + _RULES + f"SELECT {_OUT} FROM ru WHERE lift >= 1.2 AND (list_contains(a, 'disc=mid') OR list_contains(b, 'disc=mid'))")
def q_involving(spark, d):
    return flat(rules.rules_involving(mined(spark, d), ["disc=mid"]))


@query(
    "itemset_membership",
    TRX + _RULES + """SELECT array_to_string(a, ', ') AS antecedents, array_to_string(b, ', ') AS consequents,
    CASE WHEN list_has_any(list_concat(a, b), ['flag=R', 'disc=high']) THEN 1 ELSE 0 END AS touches,
    CASE WHEN array_to_string(b, ' ') LIKE '%target=%' THEN 1 ELSE 0 END AS has_target FROM ru WHERE lift >= 1.2""",
)
def q_membership(spark, d):
    return mined(spark, d).select(
        F.concat_ws(", ", "antecedents").alias("antecedents"),
        F.concat_ws(", ", "consequents").alias("consequents"),
        rules.touches_items(["flag=R", "disc=high"]).cast("int").alias("touches"),
        rules.consequent_contains("target=").cast("int").alias("has_target"),
    )


@query(
    "rules_per_segment",
    TRX + itemset_sql("segment") + _SPLIT.format(g="segment, ", g2="ab.segment, ", x=" AND x.segment = ab.segment", y=" AND y.segment = ab.segment")
    + f"SELECT segment, {_OUT} FROM ru WHERE lift >= 1.2 AND list_contains(b, 'target=yes')",
)
def q_segment(spark, d):
    return flat(rules.rules_per_segment(cut_lineage(baskets(spark, d)), "segment", consequent_has="target=yes"), "segment")


@query(
    "item_noise_filter",
    TRX + "SELECT flag, target, array_to_string(list_filter(['flag=' || flag, CASE WHEN target <> 'no' THEN 'target=' || target END], lambda x: x IS NOT NULL), ', ') AS items FROM trx",
)
def q_noise(spark, d):
    rows = encode.one_hot_items(trx(spark, d), ["flag", "target"])
    out = rules.drop_noise_items(rows, ["flag", "target"], ["flag"], "no")
    return out.select("flag", "target", F.concat_ws(", ", "items").alias("items"))


@query("head", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 10")
def q_head(spark, d):
    from ..bindings import table

    return table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_totalprice").orderBy("o_orderkey").limit(10)
