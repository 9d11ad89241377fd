"""Generated ids as pure functions of the natural key.

A packed id needs no shuffle and no counter: it is the parent id shifted left with a small ordinal in
the freed bits. It cannot collide, keeps the children of one parent next to each other (so parquet
min/max statistics still prune on it), and a task that is run again computes the same id.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

VARIANT_BITS = 4
ORDINAL_BITS = 20
#: Ids of a source come in blocks of so many consecutive ones; a block of a dataset gets a number of its own.
BLOCK_BITS = 16
#: A relation id holds an article, a configuration, a part and two variants, which leaves so many blocks.
MOST_BLOCKS = 1 << (63 - 3 * VARIANT_BITS - ORDINAL_BITS - BLOCK_BITS)


def packed_id(parent: Column, ordinal: Column, bits: int) -> Column:
    """``parent * 2**bits + ordinal``; raises if either does not fit rather than wrapping around."""
    child = ordinal.cast("long")
    fits = child.between(0, (1 << bits) - 1) & parent.between(0, (1 << (63 - bits)) - 1)
    packed = F.shiftleft(parent.cast("long"), bits).bitwiseOR(child)
    return F.when(fits, packed).otherwise(F.raise_error(F.lit("id out of range for packing")))


def variant_id(parent: Column, variant: Column | int) -> Column:
    """Id of the row that belongs to ``parent`` under a generation variant (0 to 15)."""
    column = variant if isinstance(variant, Column) else F.lit(variant)
    return packed_id(parent, column, VARIANT_BITS)


def part_id(article_id: Column, part_no: Column, config_no: int = 0) -> Column:
    """Id of the ``part_no``-th window of an article under chunk configuration ``config_no``."""
    return packed_id(packed_id(article_id, F.lit(config_no), VARIANT_BITS), part_no, ORDINAL_BITS)


def owner_of_part(part: Column) -> Column:
    """Article id that a part id was packed from."""
    return F.shiftright(part, VARIANT_BITS + ORDINAL_BITS)


def config_of_part(part: Column) -> Column:
    """Number of the chunk configuration that a part id was packed from."""
    return F.shiftright(part, ORDINAL_BITS).bitwiseAND(F.lit((1 << VARIANT_BITS) - 1))


def source_block(source_id: Column) -> Column:
    """The block that an id of a source is in."""
    return F.shiftright(source_id, BLOCK_BITS)


def in_block(block: Column, source_id: Column) -> Column:
    """The id of an article whose block has this number: its place in the block stays."""
    return F.shiftleft(block, BLOCK_BITS).bitwiseOR(source_id.bitwiseAND(F.lit((1 << BLOCK_BITS) - 1)))


def hashed_id(*natural_key: Column) -> Column:
    """64-bit hash of a natural key, for keys that do not pack; check it with ``key_collisions``."""
    return F.xxhash64(*natural_key)
