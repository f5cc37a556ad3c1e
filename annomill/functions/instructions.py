"""The scoring text, as column expressions.

Everything before and after the prompt depends on the rubric alone, so a
rubric row can carry both halves ready-made and a pair costs one ``concat``.
"""

from string import Formatter

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..fixed_values import INSTRUCTION_TEMPLATE

_BEFORE, _AFTER = INSTRUCTION_TEMPLATE.split("{prompt}")


def _fill(template: str, **fields: Column) -> Column:
    pieces = []
    for text, field, _, _ in Formatter().parse(template):
        if text:
            pieces.append(F.lit(text))
        if field:
            pieces.append(fields[field])
    return F.concat(*pieces)


def instruction_prefix(name: Column, rubric: Column) -> Column:
    return _fill(_BEFORE, name=name, rubric=rubric)


def instruction_suffix(name: Column) -> Column:
    return _fill(_AFTER, name=name)


def render_instruction(name: Column, rubric: Column, prompt: Column) -> Column:
    return F.concat(instruction_prefix(name, rubric), prompt, instruction_suffix(name))
