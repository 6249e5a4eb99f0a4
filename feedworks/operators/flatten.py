"""List cell -> child rows.

Every function is a narrow transformation (``explode`` / ``posexplode`` in the
same stage as the scan): no shuffle, and a long list never leaves its own row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from feedworks.functions import lists
from feedworks.functions.staged import clean_columns, worked_out
from feedworks.functions.text import _col, jtrim, safe_str


def with_surrogate_id(df: DataFrame, name: str) -> DataFrame:
    """Unique (not dense) 64-bit id per row, computed inside each task."""
    return df.select(F.monotonically_increasing_id().alias(name), *df.columns)


def with_ids(rows: DataFrame, name: str, first: int = 0) -> DataFrame:
    """K14 over loads: dense ids from ``first`` on for the rows of a Parquet scan.

    Two passes: rows are counted by file, and the sums over the files before give each file its
    first id; a row's place in its file does the rest.  Files and places stay what they
    are however the scan is split, so a repeated task gives the same ids.  The sums,
    one row for each file, are broadcast.
    """
    placed = rows.select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_place"))
    before = F.coalesce(F.sum("_n").over(W.orderBy("_file").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    sizes = placed.groupBy("_file").agg(F.count(F.lit(1)).alias("_n")).select("_file", before.alias("_before"))
    return placed.join(F.broadcast(sizes), "_file").select(
        (F.lit(first).cast("long") + F.col("_before") + F.col("_place")).alias(name), *rows.columns)


def explode_list(df: DataFrame, key: str, items: Column, item_name: str,
                 key_name: str | None = None) -> DataFrame:
    """One row per list item; rows whose list is empty or blank yield nothing."""
    return df.select(F.col(key).alias(key_name or key), F.explode(items).alias(item_name))


def explode_ids(df: DataFrame, key: str, cell, id_name: str, key_name: str | None = None,
                compat: bool = False, drop_self: bool = False, keep: tuple[str, ...] = ()) -> DataFrame:
    """Id-list cell -> (key, id) edge rows, ids cleaned by C2.

    Same rows as ``explode(parse_ids(cell))``, but the items are exploded first and
    cleaned afterwards, so C2 runs in whole-stage generated code rather than inside
    an (interpreted) lambda.  ``drop_self`` removes edges pointing back to the row's
    own key (P4).
    """
    out_key = key_name or key
    parts = lists.id_items(cell, compat=compat)
    raw = worked_out(df, _parts=parts).select(F.col(key).alias(out_key), *keep, F.explode("_parts").alias("_item"))
    ids = clean_columns(raw, [("_id", "int", "_item")], keep=[out_key, *keep])
    out = worked_out(ids, **{id_name: F.col("_id")}).select(out_key, id_name, *keep).filter(F.col(id_name).isNotNull())
    if drop_self:
        out = out.filter(F.col(id_name) != F.col(out_key))
    return out


def explode_strs(df: DataFrame, key: str, cell, item_name: str, key_name: str | None = None,
                 compat: bool = False) -> DataFrame:
    """String-list cell -> (key, item) rows (C8 per item)."""
    return explode_list(df, key, lists.parse_strs(cell, compat=compat), item_name, key_name)


def explode_normalized(df: DataFrame, key: str, cell, item_name: str,
                       key_name: str | None = None, compat: bool = False,
                       max_len: int = 200) -> DataFrame:
    """Ingredients.  C5 normalises the cell, items are then cleaned (C1 / C8) and
    blank items dropped (P3).

    ``compat=True`` re-parses the C5 text form with the original C8 rule, keeping
    its bracket and quote remnants.
    """
    if compat:
        items = lists.parse_strs(lists.normalize_list_text(cell), compat=True, max_len=max_len)
    else:
        items = F.transform(lists.normalize_list(cell), lambda x: safe_str(x, max_len))
    return explode_list(df, key, lists.nonblank_items(items), item_name, key_name)


def explode_steps(df: DataFrame, key: str, cell, text_name: str = "instruction_text",
                  order_name: str = "step_order", key_name: str | None = None,
                  compat: bool = False, max_len: int = 200) -> DataFrame:
    """Ordered steps.  Items are parsed (C8), blank items dropped (P3), then
    numbered 1..n over the kept items.

    Repaired mode keeps the raw items that survive cleaning (one light predicate
    per item), numbers them with ``posexplode`` and cleans each exploded item in
    generated code, instead of cleaning inside array lambdas.

    ``compat=True`` first cuts the whole cell to ``max_len`` characters, as the
    original loader did (later steps are then lost).
    """
    out_key = key_name or key
    c = _col(cell)
    if compat:
        items = lists.nonblank_items(lists.parse_strs(safe_str(c, max_len), compat=True,
                                                      max_len=max_len))
        return df.select(F.col(key).alias(out_key), F.posexplode(items).alias("_pos", text_name)) \
            .select(out_key, (F.col("_pos") + F.lit(1)).cast("int").alias(order_name), text_name)
    kept = F.filter(lists.repaired_items(c), lists.item_kept)
    exploded = df.select(F.col(key).alias(out_key), F.posexplode(kept).alias("_pos", "_item"))
    # Staged so the unquoting and trimming run once per item (kept items are never
    # blank or "null", so C1 reduces to the cut).
    unquoted = exploded.select(out_key, "_pos", jtrim(lists.strip_item_quotes(F.col("_item"))).alias("_t"))
    return unquoted.select(out_key, (F.col("_pos") + F.lit(1)).cast("int").alias(order_name),
                           jtrim(F.substring("_t", 1, max_len)).alias(text_name))
