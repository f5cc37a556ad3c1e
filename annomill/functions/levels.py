"""Reading a demand level out of a model's answer."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..fixed_values import LEVEL_MAX, LEVEL_MIN, NAMED_FINISH_REASONS, OTHER_FINISH_REASON

# The last run of digits, if it is a level with or without leading zeros.  The
# look-behind pins the match to the start of a run and the possessive quantifier
# never backs up, so a text is scanned in linear time however long it is.
_LAST_LEVEL = rf"(?<![0-9])0*([{LEVEL_MIN}-{LEVEL_MAX}])[^0-9]*+\z"
_ONLY_NUMBER_LEADS = r"\A\n?[0-9]++[^0-9]*+\z"


def conclusion(response: Column) -> Column:
    """The text after the last blank line."""
    return F.substring_index(response, "\n\n", -1)


def extract_level(response: Column, guard_section_number: bool = False) -> Column:
    """Last whole number of the conclusion if it is a level, else NULL.

    Only ASCII digits count; signs and decimal points do not, so ``-3`` is 3
    and ``3.5`` is 5.  With ``guard_section_number`` a conclusion whose only
    number is its first word, as in ``4. Not applicable``, gives NULL.
    """
    last = conclusion(response)
    level = F.regexp_extract(last, _LAST_LEVEL, 1).try_cast("double")
    if guard_section_number:
        return F.when(~last.rlike(_ONLY_NUMBER_LEADS), level)
    return level


def finish_bucket(reason: Column) -> Column:
    """``stop`` and ``length`` by name, all else (NULL too) ``other``."""
    return F.when(reason.isin(*NAMED_FINISH_REASONS), reason).otherwise(OTHER_FINISH_REASON)
