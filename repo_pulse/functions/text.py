"""Text helpers."""

from __future__ import annotations

import string
import sys
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

# Every character Unicode counts as white space, plus the separators 1C to 1F.
WHITE_SPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    + "".join(chr(code) for code in range(0x2000, 0x200B))
    + "\u2028\u2029\u202f\u205f\u3000"
)




@lru_cache(maxsize=1)
def _folds() -> tuple[str, str, dict[str, str]]:
    """What full case folding makes of characters beyond ASCII, from Python's tables of Unicode:
    characters that fold to one, what they fold to, and those that fold to several."""
    one, several = {}, {}
    for code in range(0x80, sys.maxunicode + 1):
        folded = chr(code).casefold()
        if folded != chr(code):
            (one if len(folded) == 1 else several)[chr(code)] = folded
    return "".join(one), "".join(one.values()), several


def _case_folded(text: Column) -> Column:
    single, to, several = _folds()
    pairs = F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b")) for a, b in several.items()])
    capitals = string.ascii_uppercase
    translated = F.translate(text, capitals + single, capitals.lower() + to)
    return F.aggregate(pairs, translated, lambda done, pair: F.replace(done, pair["a"], pair["b"]))


def normalize(column: Column) -> Column:
    """Strip white space and fold case, as `str.strip` and `str.casefold` do. A native trim: no
    regular expression per row, and only text beyond ASCII is folded character by character."""
    text = F.btrim(column, F.lit(WHITE_SPACE))
    is_ascii = F.length(text) == F.octet_length(text)
    return F.when(is_ascii, F.lower(text)).otherwise(_case_folded(text))
