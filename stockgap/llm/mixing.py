"""Mixing sources to target weights by iterative proportional fitting.

Documents fall into cells (source, language, topic).  The cells' expected
tokens are raked to one target per source, per language and per topic in turn,
and a cell never gives more tokens than it has: what a full cell cannot give,
the next sweeps take from the others of its margins.  Sweeps go on until no
cell moves any more.  A document then stays with the calibrated probability of
its cell, expected tokens over tokens.  DataFrame functions only.

Default targets temper the shares that the corpus has: share ** alpha, scaled
to one.  A margin value without enough tokens for its target is set to all it
has, and the others of its margin share the rest.  Three margins may still ask
for more than the full cells leave; then the sample comes as near as the sweeps
get, and :func:`residuals` says by how much each target is missed.

Edge cases: null source, language or topic is a category of its own, the empty
name; null and empty texts have no tokens, and cells without tokens stay whole;
rows that repeat an id share one coin, and so do all rows without id; texts of
any length are counted whole; an empty table gives an empty sample.  Columns of
any names are carried along; an added column gets underscores in front if its
name is taken.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from .common import own_names, staged, text_of

DIMS = ("source", "lang", "topic")
ALPHA = {"source": 0.5, "lang": 0.7, "topic": 0.6}
#: sweeps stop when no cell moves by more than this share of the budget
TOLERANCE = 5e-5
MAX_SWEEPS = 100
BUDGET = 0.5
SEED = "mix-1"
_P = "__mix_"


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(r"[^ \t\n\r\x0B\f]+")).cast("long")


def genre(text: Column, n_tokens: Column) -> Column:
    """A topic for corpora that carry none: the kind of text, by rule."""
    bars = F.length(text) - F.length(F.replace(text, F.lit("|"), F.lit("")))
    return (F.when((bars > 0) & (bars * 5 >= n_tokens), "table")
            .when(text.contains("icensed under") | text.contains("ll rights reserved"), "legal")
            .when(text.rlike(r"[A-Za-z0-9]@[A-Za-z0-9]|[0-9]{3}[ .-][0-9]{3}"), "contact")
            .when(n_tokens < 100, "brief").when(n_tokens < 1000, "article").otherwise("long"))


def _profiled(docs: DataFrame, topic: Column | None) -> DataFrame:
    """``docs`` with the mixing columns (prefixed, so nothing clashes): n, and
    source, lang and topic with null read as the empty name."""
    text = text_of(docs["text"])
    n = docs.withColumn(_P + "n", word_count(text))
    kind = genre(text, F.col(_P + "n")) if topic is None else topic
    return n.withColumns({_P + "source": F.coalesce(docs["source"].cast("string"), F.lit("")),
                          _P + "lang": F.coalesce(docs["lang"].cast("string"), F.lit("")),
                          _P + "topic": F.coalesce(kind.cast("string"), F.lit(""))})


def with_targets(cells: DataFrame, targets: Mapping[str, Mapping[str, float]] | None = None,
                 alpha: Mapping[str, float] = ALPHA, budget: float = BUDGET) -> DataFrame:
    """``cells`` (source, lang, topic, tokens) with, for each margin, the tokens
    asked for its value (``w_...``) and those that can be had (``t_...``).

    ``targets`` may name a margin's shares (values it leaves out get none);
    a margin it does not name is tempered by ``alpha``.
    """
    now = staged(cells.select(*DIMS, F.col("tokens").cast("double").alias("tokens")))
    total = now.agg(F.sum("tokens")).first()[0] or 0.0
    for d in DIMS:
        margin = now.groupBy(d).agg(F.sum("tokens").alias("tokens"))
        if targets and d in targets:
            given = F.map_from_arrays(F.array(*map(F.lit, targets[d])), F.array(*map(F.lit, targets[d].values())))
            margin = margin.withColumn("share", F.coalesce(given[F.col(d)], F.lit(0.0)))
        else:
            margin = margin.withColumn("raw", F.pow(F.col("tokens") / F.lit(total or 1.0), F.lit(alpha[d])))
            whole = margin.agg(F.sum("raw")).first()[0] or 1.0
            margin = margin.withColumn("share", F.col("raw") / F.lit(whole)).drop("raw")
        reach = calibrate(margin, budget).select(d, (F.lit(budget * total) * F.col("share")).alias("w_" + d),
                                                 F.when(F.col("share") > 0, F.col("tokens") * F.col("probability")).otherwise(0.0).alias("t_" + d))
        now = now.join(reach, d)
    return staged(now)


def rake(cells: DataFrame, targets: Mapping[str, Mapping[str, float]] | None = None, alpha: Mapping[str, float] = ALPHA,
         budget: float = BUDGET, tolerance: float = TOLERANCE, max_sweeps: int = MAX_SWEEPS) -> DataFrame:
    """``cells`` with their targets (see :func:`with_targets`) and ``expected``
    tokens: raked to the three margins in turn, at most ``tokens`` a cell.

    It ends when a sweep moves no cell by more than ``tolerance`` times the
    budget, or after ``max_sweeps``.
    """
    now = with_targets(cells, targets, alpha, budget).withColumn("expected", F.lit(budget) * F.col("tokens"))
    names = now.columns
    still = tolerance * budget * (now.agg(F.sum("tokens")).first()[0] or 0.0)
    for _ in range(max_sweeps):
        now = now.withColumn("old", F.col("expected"))
        for d in DIMS:
            margin = now.groupBy(d).agg(F.sum("expected").alias("m"))
            scaled = F.when(F.col("m") > 0, F.col("expected") * F.col("t_" + d) / F.col("m")).otherwise(0.0)
            now = now.join(margin, d).withColumn("expected", F.least(F.col("tokens"), scaled)).drop("m")
        seen = Observation()
        now = staged(now.observe(seen, F.max(F.abs(F.col("expected") - F.col("old"))).alias("moved")).select(*names))
        if (seen.get["moved"] or 0.0) <= still:
            break
    return now


def residuals(raked: DataFrame) -> DataFrame:
    """(margin, value, wanted, reachable, expected): the tokens a target asks
    for, those its value can give, and those the sample will have, as shares of
    all expected tokens; from :func:`rake`'s rows."""
    total = raked.agg(F.sum("expected")).first()[0] or 1.0
    share = lambda c: (F.max(c) / F.lit(total))
    parts = [raked.groupBy(F.lit(d).alias("margin"), F.col(d).alias("value")).agg(
        share("w_" + d).alias("wanted"), share("t_" + d).alias("reachable"), (F.sum("expected") / F.lit(total)).alias("expected")) for d in DIMS]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def calibrate(shares: DataFrame, budget: float = BUDGET, max_rounds: int = 100) -> DataFrame:
    """``shares`` with ``probability``: min(1, c * share / tokens), c such
    that the expected tokens are ``budget`` times all tokens.  A cell without
    tokens costs nothing and stays."""
    shares = staged(shares)
    tokens, all_shares = shares.agg(F.sum("tokens").cast("double"), F.sum("share")).first()
    want = budget * (tokens or 0.0)
    c = want / all_shares if all_shares else 0.0
    for _ in range(max_rounds):
        full = F.col("tokens") <= F.lit(c) * F.col("share")
        kept, open_ = shares.agg(F.sum(F.when(full, F.col("tokens"))).cast("double"), F.sum(F.when(~full, F.col("share")))).first()
        new = (want - (kept or 0.0)) / open_ if open_ else c
        if new <= c:
            break
        c = new
    return shares.withColumn("probability", F.when(F.col("tokens") > 0, F.least(F.lit(1.0), F.lit(c) * F.col("share") / F.col("tokens"))).otherwise(1.0))


def coin(doc_id: Column, seed: str = SEED) -> Column:
    """A number in [0, 1) that depends on the id alone."""
    text = F.concat(F.lit(seed + ":"), F.coalesce(doc_id.cast("string"), F.lit("null")))
    return F.conv(F.substring(F.md5(text), 1, 12), 16, 10).cast("double") / float(1 << 48)


def mix(docs: DataFrame, targets: Mapping[str, Mapping[str, float]] | None = None, alpha: Mapping[str, float] = ALPHA,
        budget: float = BUDGET, topic: Column | None = None, seed: str = SEED, details: bool = False) -> DataFrame:
    """The documents drawn: a document stays if its coin is under its cell's
    probability.  Same columns; ``details`` adds topic, n_tokens, probability.
    """
    own = _profiled(docs, topic)
    small = own.select(F.col(_P + "n").alias("n"), *[F.col(_P + d).alias(d) for d in DIMS])
    cells = staged(small.groupBy(*DIMS).agg(F.sum("n").alias("tokens")))
    chance = F.when(F.col("tokens") > 0, F.col("expected") / F.col("tokens")).otherwise(1.0)
    drawn = rake(cells, targets, alpha, budget).select(*[F.col(d).alias(f"{_P}{d}") for d in DIMS], chance.alias(_P + "p"))
    out = own.join(drawn, [_P + d for d in DIMS]).where(coin(docs["doc_id"], seed) < F.col(_P + "p"))
    added = [F.col(_P + c).alias(n) for c, n in zip(("topic", "n", "p"), own_names(docs, "topic", "n_tokens", "probability"))]
    return out.select(*[docs[c] for c in docs.columns], *(added if details else []))


def oracle(budget: float = BUDGET, seed: str = SEED) -> str:
    """DuckDB SQL for ``mix(details=True)`` with default targets: reachable
    targets by sorting the values of a margin, sweeps as a recursive query over
    window sums."""
    t = "coalesce(text, '')"
    sweep = "(SELECT *, x AS old FROM f WHERE change > still AND sweep < %d)" % MAX_SWEEPS
    for d in DIMS:
        sweep = f"""(SELECT * EXCLUDE (m) REPLACE (least(tokens, CASE WHEN m > 0 THEN x * t_{d} / m ELSE 0 END) AS x)
              FROM (SELECT *, sum(x) OVER (PARTITION BY {d}) AS m FROM {sweep}))"""
    reach = "".join(f""",
      r_{d} AS MATERIALIZED (
        SELECT {d}, cap, CASE WHEN k * share > cap OR k IS NULL THEN cap ELSE k * share END AS t_{d}
        FROM (SELECT {d}, cap, share, arg_min(k, cap / share) FILTER (k * share <= cap) OVER () AS k
              FROM (SELECT {d}, cap, share, (({budget} * sum(cap) OVER ()) - coalesce(sum(cap) OVER (ORDER BY cap / share, {d} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
                           / sum(share) OVER (ORDER BY cap / share, {d} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS k
                    FROM (SELECT {d}, cap, raw / sum(raw) OVER () AS share FROM (SELECT {d}, sum(tokens) AS cap, pow(sum(tokens) / sum(sum(tokens)) OVER (), {ALPHA[d]}) AS raw
                          FROM cells GROUP BY {d} HAVING sum(tokens) > 0)))))""" for d in DIMS)
    return f"""WITH RECURSIVE docs AS (
        SELECT doc_id, coalesce(source, '') AS source, coalesce(lang, '') AS lang, {t} AS text,
               len(regexp_extract_all({t}, '[^ \\t\\n\\r\\x0B\\f]+')) AS n_tokens,
               length({t}) - length(replace({t}, '|', '')) AS bars FROM documents),
      kinds AS MATERIALIZED (SELECT doc_id, source, lang, n_tokens, CASE
          WHEN bars > 0 AND bars * 5 >= n_tokens THEN 'table'
          WHEN contains(text, 'icensed under') OR contains(text, 'll rights reserved') THEN 'legal'
          WHEN regexp_matches(text, '[A-Za-z0-9]@[A-Za-z0-9]|[0-9]{{3}}[ .-][0-9]{{3}}') THEN 'contact'
          WHEN n_tokens < 100 THEN 'brief' WHEN n_tokens < 1000 THEN 'article' ELSE 'long' END AS topic FROM docs),
      cells AS MATERIALIZED (SELECT source, lang, topic, sum(n_tokens)::DOUBLE AS tokens FROM kinds GROUP BY ALL){reach},
      f AS (
        SELECT 0 AS sweep, source, lang, topic, tokens, {', '.join(f'coalesce(t_{d}, 0) AS t_{d}' for d in DIMS)}, {budget} * tokens AS x,
               {TOLERANCE} * {budget} * sum(tokens) OVER () AS still, 1e300 AS change
        FROM cells {' '.join(f'LEFT JOIN r_{d} USING ({d})' for d in DIMS)}
        UNION ALL
        SELECT sweep + 1, source, lang, topic, tokens, {', '.join(f't_{d}' for d in DIMS)}, x, still, max(abs(x - old)) OVER () FROM {sweep}),
      w AS (SELECT *, CASE WHEN tokens > 0 THEN x / tokens ELSE 1.0 END AS p FROM f WHERE sweep = (SELECT max(sweep) FROM f))
      SELECT doc_id, k.source, k.lang, k.topic, n_tokens, round(p, 9) AS probability
      FROM kinds k JOIN w ON k.source = w.source AND k.lang = w.lang AND k.topic = w.topic
      WHERE ('0x' || substr(md5('{seed}:' || coalesce(doc_id::VARCHAR, 'null')), 1, 12))::BIGINT / {float(1 << 48)} < p"""
