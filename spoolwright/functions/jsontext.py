"""JSON in ASCII, inside the JVM: what to_json() writes, with every other character as the escapes of its UTF-16 units."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: An escape as it stands, a run of printable ASCII, or one other character.
PARTS = r"\\(?:u[0-9A-Fa-f]{4}|.)|[\x20-\x5B\x5D-\x7E]+|[^\x20-\x7E]"


def ascii_json(text: Column) -> Column:
    """A JSON text with the same value in ASCII: escapes have small letters, characters beyond U+FFFF are two escapes, and DEL is one.

    Strings come out as Python's json.dumps writes them; objects as it does with separators of no space. Texts of printable ASCII without
    an escape by number are left as they are.
    """

    def unit(c: Column) -> Column:
        h = F.lower(F.hex(F.encode(c, "UTF-16BE")))
        first = F.concat(F.lit("\\u"), F.substring(h, 1, 4))
        return F.when(F.length(h) > 4, F.concat(first, F.lit("\\u"), F.substring(h, 5, 4))).otherwise(first)

    def part(c: Column) -> Column:
        return F.when(c.startswith("\\u"), F.concat(F.lit("\\u"), F.lower(F.substring(c, 3, 4)))).when(c.rlike(r"^[\x20-\x7E]"), c).otherwise(unit(c))

    parts = F.call_function("regexp_extract_all", text, F.lit(PARTS), F.lit(0))
    plain = ~text.rlike(r"[^\x20-\x7E]|\\u")
    return F.when(plain, text).otherwise(F.array_join(F.transform(parts, part), ""))
