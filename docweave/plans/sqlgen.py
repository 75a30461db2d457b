"""DuckDB SQL fragments that mirror the Spark Column functions.

They exist only to state each registered query a second time in plain SQL
for the oracle comparison; nothing in the engine executes them.
"""

from __future__ import annotations

from docweave.functions.text import CONTRACTION_SPLITS, KEEP_CLASS, STOP_WORDS, WS_CLASS


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def clean(e: str) -> str:
    return (f"lower(trim(regexp_replace(regexp_replace({e}, '[^{KEEP_CLASS}]', '', 'g'), "
            f"'[{WS_CLASS}]+', ' ', 'g')))")


def tokens(clean_expr: str) -> str:
    cases = " ".join(f"WHEN t = {q(w)} THEN [{', '.join(q(p) for p in parts)}]"
                     for w, parts in CONTRACTION_SPLITS)
    return (f"flatten(list_transform(list_filter(string_split({clean_expr}, ' '), lambda t: t <> ''), "
            f"lambda t: CASE {cases} ELSE [t] END))")


STOP_LIST = "[" + ", ".join(q(w) for w in STOP_WORDS) + "]"


def drop_stop(tok_expr: str) -> str:
    return f"list_filter({tok_expr}, lambda t: NOT list_contains({STOP_LIST}, t))"


def doc_tokens_cte(stop: bool = True, table: str = "documents", id_col: str = "doc_id",
                   text_col: str = "text", name: str = "dtok") -> str:
    t = tokens(clean(text_col))
    if stop:
        t = drop_stop(t)
    return f"{name} AS (SELECT {id_col}, {t} AS toks FROM {table})"


def token_chunks_cte(size: int, src: str = "dtok", id_col: str = "doc_id", name: str = "chunks") -> str:
    return (f"{name}_i AS (SELECT {id_col}, unnest(generate_series(0, (len(toks) - 1) // {size})) AS chunk_id, toks "
            f"FROM {src} WHERE len(toks) > 0), "
            f"{name} AS (SELECT {id_col}, chunk_id::BIGINT AS chunk_id, "
            f"array_to_string(list_slice(toks, chunk_id * {size} + 1, chunk_id * {size} + {size}), ' ') AS chunk_text "
            f"FROM {name}_i)")


def hashed_vectors_ctes(src: str, key_cols: str, text_col: str, dim: int = 64, prefix: str = "h",
                        max_tokens: int | None = None) -> str:
    """Sparse hashed vectors: rows (<keys>, b, v) with v a FLOAT like the
    Spark encoder, plus <prefix>_norm(<keys>, n) over all keys."""
    words = f"list_filter(string_split({text_col}, ' '), lambda t: t <> '')"
    if max_tokens:
        words = f"list_slice({words}, 1, {max_tokens})"
    return (
        f"{prefix}_tok AS (SELECT {key_cols}, unnest({words}) AS w FROM {src}), "
        f"{prefix}_code AS (SELECT {key_cols}, (('0x' || substr(md5(w), 1, 8))::BIGINT) % {dim} AS b, "
        f"CASE WHEN ('0x' || substr(md5(w), 9, 1))::INTEGER < 8 THEN 1 ELSE -1 END AS s FROM {prefix}_tok), "
        f"{prefix}_cnt AS (SELECT {key_cols}, b, sum(s)::DOUBLE AS c FROM {prefix}_code GROUP BY ALL), "
        f"{prefix}_ssq AS (SELECT {key_cols}, sqrt(sum(c * c)) AS n FROM {prefix}_cnt GROUP BY ALL), "
        f"{prefix}_vec AS (SELECT {key_cols}, b, CAST(c / n AS FLOAT)::DOUBLE AS v "
        f"FROM {prefix}_cnt JOIN {prefix}_ssq USING ({key_cols}) WHERE n > 0)"
    )
