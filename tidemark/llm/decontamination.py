"""Benchmark decontamination with spaced seeds, in DataFrame operations only.

A seed is the hash of some of the tokens in a window of ``SPAN``: a fixed mask says which, so that a
window still hits when tokens at the ignored places were substituted. Every window of every text and of
every benchmark item is hashed under every mask and joined. Hits on one diagonal (same shift between text
and item) are then verified over the whole item: the tokens that agree along the diagonal must be at least
``MATCHED``, or all of a shorter item, and ``AGREE`` percent must agree in some part from the begin of one
hit to the end of the same or a later one, or in the whole item. All such parts are tried, so that further
copied tokens never hide an item.

An item of fewer than ``SHORT`` tokens must agree in ``AGREE`` percent as a whole, which leaves up to two
tokens free. It has masks of its own length, made so that one of them ignores any such choice of tokens: no
text that agrees is missed, also where it begins or ends within the item.

Tokens are lower-cased and cut at white space and ASCII punctuation. An item without tokens matches nothing.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import free_name, written

#: Tokens that count in a window; three masks of weight 6. Of all ways to replace a fifth of an item's tokens, they
#: hit at least 96 % at 15 tokens, 99 % at 16, and all but one in a thousand from 17 on (a test counts them).
MASKS = ("11000011011", "11101100001", "10001011011")
SPAN = len(MASKS[0])
MATCHED = 12
AGREE = 80
#: The least size of which ``AGREE`` percent are ``MATCHED`` tokens.
SHORT = -(-MATCHED * 100 // AGREE)
#: Rows of 40 bytes up to which the benchmark's seeds are broadcast; beyond, both sides are shuffled.
BROADCAST_SEEDS = 1_000_000
#: Keys of texts with a hit up to which they are broadcast, so that no other text is shuffled; beyond, all are.
BROADCAST_KEYS = 200_000


def tokens(text: str) -> Column:
    """Hashes of the tokens; their order is that of the text."""
    parts = F.array_remove(F.split(F.lower(F.col(text)), r"[\s\p{Punct}]+"), "")
    return F.transform(parts, lambda t: F.xxhash64(t))


def free(size: int) -> int:
    """How many tokens of an item of that size may differ."""
    return size * (100 - AGREE) // 100


def short_masks(size: int) -> list[str]:
    """Masks over a whole item of ``size`` tokens, one of which ignores any ``free(size)`` of them: the
    places are cut into ``free + 2`` blocks, and every choice of ``free`` blocks is ignored."""
    n = free(size)
    blocks = n + 2 if n else 1
    return ["".join("0" if place * blocks // size in ignored else "1" for place in range(size))
            for ignored in combinations(range(blocks), n)]


def _seeds(masks: list[str], tag: int) -> list[Column]:
    """The hashes of the window at ``at`` under every mask; tokens beyond the text are skipped, which makes
    a hash that no item has."""
    return [F.xxhash64(F.lit(tag + m), *[F.expr(f"get(tokens, at + {o})") for o, bit in enumerate(mask) if bit == "1"])
            for m, mask in enumerate(masks)]


def _windows(rows: DataFrame, long: bool, sizes: list[int]) -> DataFrame:
    """One row per window and mask of ``rows (tokens, ...)``: windows of ``SPAN`` if ``long``, and those for
    items of the given short sizes, which may reach beyond either end of the text by ``free`` tokens."""
    least = min([SPAN] * long + [n - free(n) for n in sizes], default=SPAN)
    before = max([free(n) for n in sizes], default=0)
    at = rows.where(f"size(tokens) >= {least}").withColumn("at", F.explode(F.expr(f"sequence(-{before}, size(tokens) - {least})")))
    seeds = _seeds(list(MASKS), 0) if long else []
    for n in sizes:
        seeds += _seeds(short_masks(n), n * 100)
    return at.withColumn("seed", F.explode(F.array(*seeds))).drop("tokens")


def _best_part() -> str:
    """``(score, low, size)`` of the part of the item, from the begin of a hit to the end of the same or a
    later one, with the highest score: ``100 - AGREE`` for a token that agrees, ``-AGREE`` for another.

    One pass over the places: ``begin`` and ``end`` are the scores of the tokens before the window and up
    to its end, ``least`` the smallest ``begin`` of the hits so far, at ``place``.
    """
    worth = lambda at: f"(100 * get(same, {at}) - {AGREE})"
    lower = "(hits[p] and a.begin < a.least)"
    least, place = f"if({lower}, a.begin, a.least)", f"if({lower}, p, a.place)"
    higher = f"(hits[p] and a.end - {least} > a.score)"
    return f"""aggregate(sequence(0, size(hits) - 1),
        named_struct('begin', 0, 'end', aggregate(slice(same, 1, {SPAN}), 0, (n, x) -> n + 100 * x - {AGREE}),
                     'least', {1 << 30}, 'place', 0, 'score', {-1 << 30}, 'low', 0, 'size', 0),
        (a, p) -> named_struct(
            'begin', a.begin + {worth("p")}, 'end', a.end + coalesce({worth(f"p + {SPAN}")}, 0), 'least', {least}, 'place', {place},
            'score', if({higher}, a.end - {least}, a.score), 'low', if({higher}, {place}, a.low),
            'size', if({higher}, p + {SPAN} - {place}, a.size)),
        a -> named_struct('score', a.score, 'low', a.low, 'size', a.size))"""


def overlaps(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text",
             item: str = "item_id", item_text: str = "text") -> DataFrame:
    """``(key, item_id, start, n_tokens, n_matched)``: one row per document and item that it holds.

    ``start`` is the token of the text at which the first hit lies, ``n_tokens`` the length from the
    first hit to the last (of a short item: what of it lies in the text), ``n_matched`` the agreeing tokens along the diagonal. Where neither that length
    nor the whole item agrees, ``start`` and ``n_tokens`` are those of the part that agrees most. Of several diagonals
    the one with most agreeing tokens is given, then the first in the text. Null keys, texts and items
    without tokens give no row; rows that repeat a key are searched each, and reported once per key and
    item. Empty tables give no rows; texts of any length are searched whole. Other columns are ignored. Benchmark seeds are broadcast below ``BROADCAST_SEEDS`` rows.
    """
    items = (benchmark.where(F.col(item).isNotNull())
             .select(F.col(item).alias("item_id"), tokens(item_text).alias("tokens")).where("size(tokens) > 0"))
    # At most one row per size below SHORT.
    sizes = sorted(r["n"] for r in items.where(f"size(tokens) < {SHORT}").select(F.size("tokens").alias("n")).distinct().collect())
    seeds = (_windows(items.where(f"size(tokens) >= {SHORT}"), True, [])
             .select("seed", "item_id", F.col("at").alias("place"), F.lit(False).alias("exact")))
    for n in sizes:
        own = items.where(f"size(tokens) = {n}").withColumn("at", F.lit(0))
        seeds = seeds.unionByName(own.select(F.explode(F.array(*_seeds(short_masks(n), n * 100))).alias("seed"), "item_id",
                                             F.lit(0).alias("place"), F.lit(free(n) == 0).alias("exact")))
    seeds = seeds.distinct()
    if seeds.count() <= BROADCAST_SEEDS:
        seeds = F.broadcast(seeds)
    rows = docs.where(F.col(key).isNotNull()).select(F.col(key).alias("key"), F.col(text).alias("text"))
    words = rows.select("key", tokens("text").alias("tokens"))
    # Items that must agree in every token agree wherever they hit: the first place of a key is enough.
    shift = F.col("at") - F.col("place")
    hits = (_windows(words, True, sizes).join(seeds, "seed")
            .groupBy("key", "item_id", F.when(~F.col("exact"), shift).alias("diagonal"))
            .agg(F.min(shift).alias("shift"), F.min("place").alias("low"), F.max("place").alias("high")))
    hits = written(hits, "hits")
    keys = hits.select("key").distinct()
    if keys.count() <= BROADCAST_KEYS:
        rows = rows.join(F.broadcast(keys), "key", "left_semi")
    found = (rows.join(hits, "key").select("key", "item_id", "shift", "low", "high", tokens("text").alias("words"))
             .join(items.select("item_id", F.col("tokens").alias("asked")), "item_id"))
    agree = found.withColumn("same", F.expr("""
        transform(asked, (t, j) -> case when j + shift >= 0 and j + shift < size(words)
                                        then cast(words[j + shift] = t as int) else 0 end)"""))
    # The windows that hit, from the tokens that agree: those of every mask.
    hit = " or ".join("(" + " and ".join(f"same[p + {o}] = 1" for o, bit in enumerate(mask) if bit == "1") + ")" for mask in MASKS)
    short = f"size(asked) < {SHORT}"
    measured = agree.select(
        "key", "item_id", "shift", "same",
        F.expr(f"if({short}, greatest(0, -shift), low)").alias("low"),
        F.expr(f"if({short}, least(size(asked), size(words) - shift) - greatest(0, -shift), high - low + {SPAN})").alias("size"),
        F.expr("aggregate(same, 0, (n, x) -> n + x)").alias("n_matched"),
        F.expr(f"aggregate(slice(same, low + 1, high - low + {SPAN}), 0, (n, x) -> n + x)").alias("inside"),
        F.expr(f"if({short}, size(asked) - size(asked) * {100 - AGREE} div 100, {MATCHED})").alias("needed")).where("n_matched >= needed")
    whole = measured.withColumn("whole", F.expr(f"inside * 100 >= {AGREE} * size or n_matched * 100 >= {AGREE} * size(same)"))
    parts = whole.withColumn("hits", F.expr(f"if(whole, array(), transform(sequence(0, size(same) - {SPAN}), p -> {hit}))"))
    parts = parts.withColumn("part", F.expr(f"if(whole, named_struct('score', 0, 'low', low, 'size', size), {_best_part()})"))
    kept = parts.where("part.score >= 0").select(
        "key", "item_id", (F.col("part.low") + F.col("shift")).alias("start"), F.col("part.size").alias("n_tokens"), "n_matched")
    best = kept.groupBy("key", "item_id").agg(F.min(F.struct(
        (-F.col("n_matched")).alias("order"), "start", "n_tokens")).alias("best"))
    return best.select(F.col("key").alias(key), "item_id", F.col("best.start").alias("start"),
                       F.col("best.n_tokens").alias("n_tokens"), (-F.col("best.order")).alias("n_matched"))


def without_benchmark(docs: DataFrame, benchmark: DataFrame, text: str = "text") -> DataFrame:
    """The rows of ``docs`` that hold no benchmark item, with all their columns.

    Texts are told apart by their digest, so that rows without an id are searched too and copies share
    one search.
    """
    name = free_name(docs, "digest")
    marked = docs.withColumn(name, F.sha2(F.coalesce(F.col(text), F.lit("")), 256))
    distinct = docs.select(F.sha2(F.col(text), 256).alias("key"), F.col(text).alias("text"))
    dirty = overlaps(distinct, benchmark, key="key").select(F.col("key").alias(name)).distinct()
    return marked.join(dirty, name, "left_anti").drop(name)


def oracle(documents: str = "documents", benchmark: str = "benchmark") -> str:
    """SQL of ``overlaps``: masked windows are compared in full instead of by hash, the parts of a diagonal
    pair by pair of its hits, and short items at every place where one of their tokens lies."""
    def windows(source: str, name: str) -> str:
        return " UNION ALL ".join(
            f"SELECT {name}, pos, {m} AS mask, [{', '.join(f'w[pos + {o + 1}]' for o, bit in enumerate(mask) if bit == '1')}] AS seed "
            f"FROM (SELECT {name}, w, unnest(range(0, len(w) - {SPAN - 1})) AS pos FROM {source})" for m, mask in enumerate(MASKS))
    cut = r"list_filter(regexp_split_to_array(lower(text), '[\s!-/:-@\[-`{-~]+'), lambda x: x <> '')"
    return f"""
    WITH d AS (SELECT doc_id, {cut} AS w FROM {documents} WHERE doc_id IS NOT NULL),
    b AS (SELECT item_id, {cut} AS w FROM {benchmark} WHERE item_id IS NOT NULL),
    dl AS (SELECT * FROM d WHERE len(w) >= {SPAN}), bl AS (SELECT * FROM b WHERE len(w) >= {SHORT}),
    dw AS ({windows('dl', 'doc_id')}), bw AS ({windows('bl', 'item_id')}),
    places AS (SELECT DISTINCT doc_id, item_id, dw.pos - bw.pos AS shift, bw.pos AS place FROM dw JOIN bw ON dw.mask = bw.mask AND dw.seed = bw.seed),
    hits AS (SELECT doc_id, item_id, shift, min(place) AS low, max(place) AS high FROM places GROUP BY ALL
             UNION ALL
             SELECT DISTINCT doc_id, item_id, x.pos - y.pos, NULL, NULL
             FROM (SELECT item_id, unnest(w) AS token, unnest(range(len(w))) AS pos FROM b WHERE len(w) < {SHORT}) y
             JOIN (SELECT doc_id, unnest(w) AS token, unnest(range(len(w))) AS pos FROM d
                   WHERE (SELECT min(len(w)) FROM b) < {SHORT}) x USING (token)),
    same AS (SELECT h.*, len(b.w) AS asked, len(d.w) AS words,
                    list_transform(range(0, len(b.w)), lambda j: CASE WHEN j + shift >= 0 AND j + shift < len(d.w)
                        AND d.w[j + shift + 1] = b.w[j + 1] THEN 1 ELSE 0 END) AS s
             FROM hits h JOIN d USING (doc_id) JOIN b USING (item_id)),
    measured AS (SELECT *, list_sum(s) AS n_matched, asked < {SHORT} AS short FROM same),
    enough AS (SELECT * FROM measured WHERE n_matched >= CASE WHEN short THEN asked - asked * {100 - AGREE} // 100 ELSE {MATCHED} END),
    whole AS (SELECT *, CASE WHEN short THEN true ELSE list_sum(s[low + 1:high + {SPAN}]) * 100 >= {AGREE} * (high - low + {SPAN})
                             OR n_matched * 100 >= {AGREE} * asked END AS whole FROM enough),
    parts AS (SELECT w.doc_id, w.item_id, w.shift, w.n_matched, f.place AS low, t.place + {SPAN} - f.place AS size,
                     list_sum(w.s[f.place + 1:t.place + {SPAN}]) * 100 - {AGREE} * (t.place + {SPAN} - f.place) AS score
              FROM whole w JOIN places f USING (doc_id, item_id, shift) JOIN places t USING (doc_id, item_id, shift)
              WHERE NOT whole AND f.place <= t.place
              QUALIFY row_number() OVER (PARTITION BY w.doc_id, w.item_id, w.shift ORDER BY score DESC, t.place, f.place) = 1),
    kept AS (SELECT doc_id, item_id, n_matched, greatest(0, shift) AS start, least(asked, words - shift) - greatest(0, -shift) AS n_tokens
             FROM whole WHERE short
             UNION ALL SELECT doc_id, item_id, n_matched, low + shift, high - low + {SPAN} FROM whole WHERE NOT short AND whole
             UNION ALL SELECT doc_id, item_id, n_matched, low + shift, size FROM parts WHERE score >= 0)
    SELECT doc_id, item_id, start::INT AS start, n_tokens::INT AS n_tokens, n_matched::INT AS n_matched FROM kept
    QUALIFY row_number() OVER (PARTITION BY doc_id, item_id ORDER BY n_matched DESC, start, n_tokens) = 1"""
