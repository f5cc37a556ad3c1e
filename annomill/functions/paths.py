"""Run, demand and part of a file, read off its path.

Two layouts are understood: ``<demand>[_part<i>]/output.jsonl`` and the
``demand=<demand>/part=<part>/`` folders that the writers make.  What lies above
is the run: parts of different runs may have the same name.  Paths come as URIs,
so names are decoded; the writers' folders are unescaped as well.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F


def decoded(text: Column) -> Column:
    """Percent escapes undone; a plus sign is one, and what cannot be decoded stays."""
    return F.coalesce(F.try_url_decode(F.replace(text, F.lit("+"), F.lit("%2B"))), text)


def _folder_value(folder: Column, name: str) -> Column:
    """A folder's name, or the value if it is ``name=value``."""
    plain = decoded(folder)
    return F.when(plain.startswith(f"{name}="), decoded(F.substring(plain, len(name) + 2, 1 << 30))).otherwise(plain)


def part_of_path(path: Column) -> Column:
    return _folder_value(F.element_at(F.split(path, "/"), -2), "part")


def run_of_path(path: Column) -> Column:
    """The folder that holds the parts, without the folders that only sort inputs and outputs."""
    above = F.regexp_replace(path, "/[^/]+/[^/]+$", "")
    return decoded(F.regexp_replace(F.regexp_replace(above, "/demand=[^/]*$", ""), "/(inputs|outputs)$", ""))


def demand_of_part(part: Column) -> Column:
    """A part's name up to the first underscore."""
    return F.substring_index(part, "_", 1)


def demand_of_path(path: Column) -> Column:
    named = F.regexp_extract(path, "/(demand=[^/]+)/", 1)
    return F.when(named != "", _folder_value(named, "demand")).otherwise(demand_of_part(part_of_path(path)))


def stem_of_path(path: Column) -> Column:
    """File name without its last suffix."""
    return decoded(F.regexp_extract(path, r"([^/]+?)(?:\.[^./]*)?$", 1))


def shared_keys(left: list[str], right: list[str]) -> list[str]:
    """The columns that name a part in both tables: the run as well if both have it."""
    return ["run", "part"] if "run" in left and "run" in right else ["part"]
