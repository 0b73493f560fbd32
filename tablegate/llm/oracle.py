"""SQL of the queries that SQL can express, for DuckDB."""

from __future__ import annotations

_DRAW = "('0x' || substr(md5(concat_ws(':', {})), 1, 15))::BIGINT"


def _draw(*parts) -> str:
    return _DRAW.format(", ".join(f"{p}::VARCHAR" if isinstance(p, str) else f"'{p}'" for p in parts))


def mix(docs: str = "documents", block: int = 32, shard: int = 1 << 20, seed: int = 17) -> str:
    """Query of ``mixed``: every seat is listed, the highest quotients win, and every block is a row."""
    return f"""
WITH sized AS (
    SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size FROM {docs}
), sources AS (
    SELECT source, sum(size)::BIGINT AS size FROM sized GROUP BY source
), turns AS (
    SELECT *, [3, 1, 2][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT]::DOUBLE AS weight,
           (2 * size)::DOUBLE AS cap
    FROM sources
), filling AS (
    SELECT *, (1.5::DOUBLE * (sum(size) OVER ())::DOUBLE - coalesce(sum(cap) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
           / sum(weight) OVER (w ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
    FROM turns WINDOW w AS (ORDER BY cap / weight, source NULLS LAST)
), goals AS (
    SELECT source, size AS source_size, greatest(ceil(size / {shard}::DOUBLE), 1)::BIGINT AS shards,
           CASE WHEN weight * level <= cap THEN weight * coalesce(max(level) FILTER (weight * level <= cap) OVER (), 0)
                ELSE cap END AS target,
           ceil(1.5::DOUBLE * (sum(size) OVER ())::DOUBLE / {block})::BIGINT AS seats
    FROM filling
), bids AS (
    SELECT source, seats, target / (2 * unnest(range(0, seats + 1)) + 1) AS bid, unnest(range(0, seats + 1)) AS k
    FROM goals WHERE target > 0
), source_quota AS (
    SELECT source, count(*) AS quota
    FROM (SELECT *, row_number() OVER (ORDER BY bid DESC, source NULLS LAST, k) AS place FROM bids) WHERE place <= seats GROUP BY source
), spread AS (
    SELECT s.doc_id, s.source, s.size, g.source_size, g.target, ((({_draw(seed, 's.doc_id')}) % g.shards) + g.shards) % g.shards AS shard
    FROM sized s JOIN goals g ON s.source IS NOT DISTINCT FROM g.source
), placed AS (
    SELECT *, coalesce(sum(size) OVER (PARTITION BY source, shard ORDER BY {_draw(seed + 1, 'doc_id')}, doc_id NULLS FIRST, size
                                       ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS begins,
           row_number() OVER () AS id
    FROM spread
), filled AS (
    SELECT source, shard, sum(size)::BIGINT AS words, ceil(sum(size) / {block}::DOUBLE)::BIGINT AS blocks FROM placed GROUP BY source, shard
), shard_bids AS (
    SELECT f.source, shard, quota, words / (2 * unnest(range(0, quota + 1)) + 1) AS bid, unnest(range(0, quota + 1)) AS k
    FROM filled f JOIN source_quota q ON f.source IS NOT DISTINCT FROM q.source WHERE words > 0
), shard_quota AS (
    SELECT source, shard, count(*) AS quota
    FROM (SELECT *, row_number() OVER (PARTITION BY source ORDER BY bid DESC, shard, k) AS place FROM shard_bids)
    WHERE place <= quota GROUP BY source, shard
), blocks AS (
    SELECT f.source, f.shard, unnest(range(0, blocks)) AS block, blocks, least(quota, 2 * blocks) AS quota
    FROM filled f JOIN shard_quota q ON f.source IS NOT DISTINCT FROM q.source AND f.shard = q.shard
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY source, shard ORDER BY {_draw(seed + 2, 'source', 'shard', 'block')}) AS lot FROM blocks
), times AS (
    SELECT source, shard, block, quota // blocks + (lot <= quota % blocks)::INT AS times FROM ranked
), parts AS (
    SELECT p.id, sum(times * (least((block + 1) * {block}, begins + size) - greatest(block * {block}, begins)))::BIGINT AS taken
    FROM placed p JOIN times t ON p.source IS NOT DISTINCT FROM t.source AND p.shard = t.shard
     AND t.block BETWEEN begins // {block} AND (begins + size - 1) // {block}
    WHERE size > 0 GROUP BY p.id
)
SELECT doc_id, source, size, source_size, target, coalesce(taken, 0)::BIGINT AS taken FROM placed LEFT JOIN parts USING (id)
"""


SQL: dict[str, str] = {"op1_mix_sources": mix()}
