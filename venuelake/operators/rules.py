"""Ordered keyword rules: the first rule whose keyword occurs in a text decides.

One path for rule tables and texts of any size. Keywords are indexed by their first ``PREFIX`` characters (shorter ones by all of
them). Texts are cut into pieces that reach into the next piece as far as the longest keyword, each place in a piece is looked
up in a bit table of the hashed prefixes, what stands at the places that pass is cut to each length that keywords have and looked up in
a bit table of the hashed keywords, and only what passes meets the keywords, in an equi-join. The tables grow with the rules up to
``MOST_WORDS``, so few places travel that begin no keyword. The hits of a text are reduced to the first rule. So the work is spread by
pieces and by keyword, no row tests a list of rules, and no array grows with a text but that of its pieces.

A NULL text matches nothing, and so does a rule whose keyword is NULL or blank. Columns that must be equal follow SQL: NULL
equals nothing. Of several matches the one with the lowest priority wins, then the lowest keyword, then the
lowest outputs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.sinks import stage

_EDGE = "\u0001"
#: Characters of a keyword that are looked up first, of a piece at least, and words of 64 bits in a table of hashes, at least and at most.
PREFIX, PIECE, WORDS, MOST_WORDS = 8, 64, 1 << 14, 1 << 20
#: Bytes of a digest; shorter texts stand for themselves.
DIGEST = 32


def _prepared(c: Column, mode: str, is_keyword: bool) -> Column:
    """Text and keyword brought to a form where a plain substring test decides."""
    up = F.upper(F.trim(c)) if is_keyword else F.upper(c)
    if mode == "contains":
        return up
    # Whole-word test: mark every word edge in both; the keyword must start and end at an edge.
    marked = F.regexp_replace(up, r"\b", _EDGE)
    if not is_keyword:
        return marked
    edge = F.lit(_EDGE)
    marked = F.when(F.startswith(marked, edge), marked).otherwise(F.concat(edge, marked))
    return F.when(F.endswith(marked, edge), marked).otherwise(F.concat(marked, edge))


def _text_key(c: Column) -> Column:
    """The bytes of the text if they are few, else its digest: what stands for a text while its hits are collected."""
    return F.when(F.octet_length(c) < DIGEST, c.cast("binary")).otherwise(F.unhex(F.sha2(c, 256)))


def _bit(c: Column, words: Column) -> Column:
    return F.pmod(F.xxhash64(c), words * 64)


def _bit_table(keys: DataFrame, words: Column) -> Column:
    """The table in which the bits of the keys (column ``_k``) are set, as an array of so many words."""
    filled = keys.select(_bit(F.col("_k"), words).alias("_b")).groupBy(F.shiftright("_b", 6).alias("_w")).agg(F.bit_or(F.expr("shiftleft(1L, cast(_b & 63 as int))")).alias("_x"))
    every = keys.sparkSession.range(MOST_WORDS).where(F.col("id") < words)
    return every.join(filled, F.col("id") == F.col("_w"), "left").agg(F.transform(F.sort_array(F.collect_list(F.struct("id", F.coalesce("_x", F.lit(0)).alias("x")))), lambda e: e["x"])).scalar()


def _has_bit(table: Column, c: Column, words: Column) -> Column:
    return F.getbit(F.get(table, F.shiftright(_bit(c, words), 6).cast("int")), _bit(c, words).bitwiseAND(63).cast("int")) == 1


def _hit_places(texts: DataFrame, r: DataFrame) -> DataFrame:
    """_j and _rk (what may be a keyword) of the places of ``_t`` that may begin one."""
    wanted = F.ceil(F.count("*") / F.lit(4))  # 16 bits a rule
    sizes = r.agg(F.struct(
        F.sort_array(F.collect_set(F.length("_k"))).alias("prefixes"), F.sort_array(F.collect_set(F.length("_rk"))).alias("lengths"), F.coalesce(F.max(F.length("_rk")), F.lit(1)).alias("longest"),
        F.greatest(F.lit(WORDS), F.least(F.lit(MOST_WORDS), wanted)).cast("long").alias("words"))).scalar()
    words = sizes["words"]
    begins, whole = _bit_table(r.select("_k"), words), _bit_table(r.select(F.col("_rk").alias("_k")), words)
    pattern = F.concat(F.lit("(?s).{1,"), F.greatest(F.lit(PIECE), F.col("_longest")).cast("string"), F.lit("}"))
    cut = texts.withColumn("_longest", sizes["longest"]).withColumn("_pieces", F.regexp_extract_all("_t", pattern, F.lit(0)))
    reach = lambda p, k: F.struct(F.length(p).alias("n"), F.concat(p, F.coalesce(F.substring(F.get("_pieces", k + 1), F.lit(1), F.col("_longest") - 1), F.lit(""))).alias("text"))
    pieces = cut.select("_j", F.explode(F.transform("_pieces", reach)).alias("_p"))
    places = pieces.select("_j", F.col("_p.text").alias("_text"), F.explode(F.sequence(F.lit(1), F.col("_p.n"))).alias("_i"))
    keyed = places.select("_j", "_text", "_i", F.explode(sizes["prefixes"]).alias("_n")).withColumn("_k", F.substring("_text", F.col("_i"), F.col("_n")))
    begun = keyed.where((F.length("_k") == F.col("_n")) & _has_bit(begins, F.col("_k"), words))
    # A prefix shorter than PREFIX is a whole keyword.
    tails = begun.select("_j", "_n", F.substring("_text", F.col("_i"), sizes["longest"]).alias("_tail"))
    cuts = tails.select("_j", "_n", "_tail", F.explode(sizes["lengths"]).alias("_l")).where(F.least("_l", F.lit(PREFIX)) == F.col("_n"))
    found = cuts.select("_j", "_l", F.substring("_tail", F.lit(1), F.col("_l")).alias("_rk"))
    return found.where((F.length("_rk") == F.col("_l")) & _has_bit(whole, F.col("_rk"), words)).select("_j", "_rk")


def first_match(df: DataFrame, rules: DataFrame, text_col: str, outputs: list[str], mode: str = "contains",
                keyword: str = "keyword", priority: str = "priority", equal: dict[str, str] | None = None, repeated: bool = True) -> DataFrame:
    """Add the ``outputs`` of the lowest-priority rule contained in ``text_col``, NULL when none.

    ``mode`` is 'contains' or 'word', both ignoring case. ``equal`` maps a rule column to a
    column of ``df`` that must be equal too (a weekday, say). ``repeated`` tells that many rows share a text, so texts are
    made distinct first; without it long texts are not shuffled. The answer is the same. The rules are read several times:
    stage them if they are costly to make. The hits of the texts are staged, so their size is known: few texts are broadcast
    to the rows, which then keep their place and order. ``df`` is read twice.
    """
    equal = equal or {}
    r = rules.filter(F.trim(keyword) != "").select(
        F.col(priority).alias("_p"), _prepared(F.col(keyword), mode, True).alias("_rk"),
        *[F.col(c).alias(f"_e_{c}") for c in equal], *[F.col(c).alias(f"_o_{c}") for c in outputs],
    ).withColumn("_k", F.substring("_rk", 1, PREFIX))
    texts = df.filter(F.col(text_col).isNotNull()).select(F.col(text_col).alias("_x"))
    texts = (texts.distinct() if repeated else texts).select(_text_key(F.col("_x")).alias("_j"), _prepared(F.col("_x"), mode, False).alias("_t"))
    hits = _hit_places(texts, r).join(r, "_rk")
    best = hits.groupBy("_j", *[f"_e_{c}" for c in equal]).agg(F.min(F.struct("_p", "_rk", *[f"_o_{c}" for c in outputs])).alias("_hit"))
    best = stage(best, "rule-hits")
    # NULL texts get keys that match nothing and are spread over the tasks.
    key = F.coalesce(_text_key(F.col(text_col)), F.lpad(F.xxhash64(*df.columns).cast("string"), DIGEST + 1, "-").cast("binary"))
    on = F.col("_key") == F.col("_j")
    for rule_col, df_col in equal.items():
        on = on & (F.col(df_col) == F.col(f"_e_{rule_col}"))
    return df.withColumn("_key", key).join(best, on, "left").select(*[F.col(c) for c in df.columns], *[F.col("_hit")[f"_o_{c}"].alias(c) for c in outputs])


def case_rules(cases: list[tuple[Column, object]], default: Column | None = None) -> Column:
    """Ordered tests as one expression, for short fixed rule lists; without a case the default."""
    if not cases:
        return F.lit(None) if default is None else default
    out = F
    for cond, value in cases:
        out = out.when(cond, value if isinstance(value, Column) else F.lit(value))
    return out.otherwise(default) if default is not None else out


def any_match_sums(totals: DataFrame, groups: dict[str, list[str]], text_col: str, value: str, keys: list[str]) -> DataFrame:
    """Per key, the sum of ``value`` over rows whose text contains any word of each group.

    One pass and one aggregate; a row may feed several groups.
    """
    low = F.lower(text_col)
    aggs = []
    for name, words in groups.items():
        cond = F.lit(False)
        for w in words:
            cond = cond | low.contains(w.lower())
        aggs.append(F.coalesce(F.sum(F.when(cond, F.col(value))), F.lit(0.0)).alias(name))
    return totals.groupBy(*keys).agg(*aggs) if keys else totals.agg(*aggs)
