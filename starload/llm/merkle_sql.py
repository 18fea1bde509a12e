"""The manifest of `op11_merkle` as SQL: the levels written out one by one."""

from __future__ import annotations

_FANOUT = 8


def _level(tree: str, i: int) -> str:
    """Siblings of the nodes of a level, and the level above it; an only node stays itself."""
    return f"""
{tree}_sib{i} AS (
    SELECT a.k, a.spot,
           coalesce(string_agg(b.digest, '' ORDER BY b.spot) FILTER (b.spot < a.spot), '') AS before,
           coalesce(string_agg(b.digest, '' ORDER BY b.spot) FILTER (b.spot > a.spot), '') AS after
    FROM {tree}{i} AS a JOIN {tree}{i} AS b ON a.k = b.k AND a.spot // {_FANOUT} = b.spot // {_FANOUT}
    GROUP BY a.k, a.spot
),
{tree}{i + 1} AS (
    SELECT k, spot // {_FANOUT} AS spot, (max(n) + {_FANOUT - 1}) // {_FANOUT} AS n,
           CASE WHEN max(n) = 1 THEN max(digest) ELSE sha256(string_agg(digest, '' ORDER BY spot)) END AS digest
    FROM {tree}{i} GROUP BY k, spot // {_FANOUT}
)"""


def _step(tree: str, i: int, source: str) -> str:
    """One more level of the documents' proofs and folded digests."""
    return f"""
{tree}_fold{i} AS (
    SELECT d.* EXCLUDE (spot, acc, proof), d.spot // {_FANOUT} AS spot,
           CASE WHEN t.n > 1 THEN sha256(s.before || acc || s.after) ELSE acc END AS acc,
           proof || s.before || s.after AS proof
    FROM {source} AS d
    JOIN {tree}{i} AS t ON t.k = d.k AND t.spot = d.spot
    JOIN {tree}_sib{i} AS s ON s.k = d.k AND s.spot = d.spot
)"""


def _value(column: str) -> str:
    text = f"CAST({column} AS VARCHAR)"
    return f"coalesce(strlen({text}) || ':' || {text}, '-')"


def _digest(text: str) -> str:
    parts = [*map(_value, ("doc_id", "source", "lang", "n_chars")), _value(text)]
    return f"sha256({' || '.join(parts)})"


# CRC-32 of a short text, byte by byte and bit by bit.
_CRC32 = """
xor(4294967295, list_reduce(
    list_concat([4294967295::BIGINT], list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: ascii(c)::BIGINT)),
    lambda crc, byte: list_reduce(
        list_concat([xor(crc, byte)], [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]),
        lambda x, bit: xor(x >> 1, 3988292384 * (x & 1)))))"""

_LOWERED = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def merkle_sql(depth: int = 8, groups_depth: int = 4) -> str:
    """For groups of up to 8 to the power `depth` rows, and so for the number of groups."""
    docs, folds = range(depth), range(groups_depth)
    steps = [
        f"""
docs AS (
    SELECT doc_id, {_digest('text')} AS leaf,
           CASE WHEN {_CRC32} % 3 = 0 THEN {_digest(_LOWERED)} ELSE {_digest('text')} END AS told,
           coalesce('=' || lang, '-') AS k,
           row_number() OVER (PARTITION BY lang ORDER BY doc_id) - 1 AS spot
    FROM documents
),
l0 AS (SELECT k, spot, leaf AS digest, count(*) OVER (PARTITION BY k) AS n FROM docs)""",
        *[_level("l", i) for i in docs],
        f"""
g0 AS (
    SELECT '' AS k, k AS own, row_number() OVER (ORDER BY k) - 1 AS spot, digest, count(*) OVER () AS n
    FROM l{depth}
)""",
        *[_level("g", i) for i in folds],
        "start AS (SELECT *, told AS acc, '' AS proof FROM docs)",
        *[_step("l", i, f"l_fold{i - 1}" if i else "start") for i in docs],
        f"""
grouped AS (
    SELECT f.* EXCLUDE (k, spot), g.digest AS subroot, g.k, g.spot
    FROM l_fold{depth - 1} AS f JOIN g0 AS g ON g.own = f.k
)""",
        *[_step("g", i, f"g_fold{i - 1}" if i else "grouped") for i in folds],
    ]
    return f"""
WITH {','.join(steps)}
SELECT doc_id, leaf, subroot, r.digest AS root, sha256(proof) AS proof_sha256, acc AS folded_root,
       acc = r.digest AS verified
FROM g_fold{groups_depth - 1}, g{groups_depth} AS r"""
