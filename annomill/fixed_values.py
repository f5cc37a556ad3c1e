"""Values that results depend on.  Change one and the numbers change."""

# --- Fixed values ----------------------------------------------------------

# The scoring text sent for one prompt and one rubric.
INSTRUCTION_TEMPLATE = """\
The following rubric describes six distinct levels of *{name}* required by different tasks:
{rubric}

TASK INSTANCE: {prompt}

INSTRUCTION: Score the level of *{name}* demanded by the given TASK INSTANCE using a discrete value from 0 to 5. Use CHAIN-OF-THOUGHTS REASONING to reason step by step before assigning the score. After the CHAIN-OF-THOUGHTS REASONING STEPS, conclude your assessment with the statement: "Thus, the level of *{name}* demanded by the given TASK INSTANCE is: SCORE", where SCORE is an integer score you have determined.

CHAIN-OF-THOUGHTS REASONING STEPS to score the level of *{name}* demanded by the given TASK INSTANCE above:"""

# The name, rubric and prompt that make the "empty" instruction of the
# approximate token estimate.
EMPTY_INSTRUCTION = ("", " ", "")

# Request defaults.
REQUEST_METHOD = "POST"
REQUEST_URL = "/chat/completions"
REQUEST_MODEL = "gpt-4o"
REQUEST_MAX_TOKENS = 1000
REQUEST_TEMPERATURE = 0
SYSTEM_CONTENT = ""

# Limits of one request file.
MAX_PART_BYTES = 190 * 1024 * 1024
MAX_PART_LINES = 50_000
MAX_PART_LINES_AZURE = 100_000

# USD per one million tokens, batch rates: (model key, input, output).
# The order matters: the first key contained in a model's name wins.
MODEL_PRICES = [
    ("gpt-5.2", 0.875, 7.0),
    ("gpt-5.1", 0.625, 5.0),
    ("gpt-5", 0.625, 5.0),
    ("gpt-5-mini", 0.125, 1.0),
    ("gpt-5-nano", 0.025, 0.2),
    ("gpt-5.2-pro", 10.5, 84.0),
    ("gpt-5-pro", 7.5, 60.0),
    ("gpt-4.1", 1.0, 4.0),
    ("gpt-4.1-mini", 0.2, 0.8),
    ("gpt-4.1-nano", 0.05, 0.2),
    ("gpt-4o", 1.25, 5.0),
    ("gpt-4o-mini", 0.075, 0.3),
    ("o1", 7.5, 30.0),
    ("o1-mini", 0.55, 2.2),
    ("o3", 5.0, 20.0),
    ("o3-mini", 0.55, 2.2),
    ("o4-mini", 0.55, 2.2),
    ("gpt-4", 15.0, 30.0),
    ("gpt-4-turbo", 5.0, 15.0),
    ("gpt-3.5-turbo", 0.25, 0.75),
]

# A level is a whole number in this range, both ends included.
LEVEL_MIN, LEVEL_MAX = 0, 5

# Finish reasons kept by name; every other one counts as "other".
NAMED_FINISH_REASONS = ("stop", "length")
OTHER_FINISH_REASON = "other"

# Rubric checks.  (?U) gives \s its Unicode meaning in Java.
RUBRIC_LEVEL_PATTERN = r"(?U)[Ll]evel\s*[0-5]"
RUBRIC_EXAMPLE_PATTERN = r"(?i)examples?"
RUBRIC_MIN_MENTIONS = 6
RUBRIC_MIN_CHARS = 100

# Messages of the rubric checks.
MSG_EMPTY_FILE = "Empty rubric file"
MSG_NO_NAME = "Missing full name on first line"
MSG_NO_HASH = "First line must contain full name starting with '#'"
MSG_NO_CONTENT = "Missing rubric content"
MSG_EMPTY_CONTENT = "Empty rubric content"
MSG_LEVELS = "Rubric should contain, at least, all level descriptions from Level 0 to Level 5."
MSG_SHORT = "Rubric content seems too short"
MSG_NO_EXAMPLES = "Rubric should contain examples for each level"
MSG_FEW_EXAMPLES = "Rubric should contain at least one example for each Level from 0 to 5"
MSG_VALID = "Valid rubric"

# --- End of fixed values ---------------------------------------------------

# Token pattern of the default counter: runs of letters, up to three digits,
# runs of other visible characters.  No token spans white space.
TOKEN_PATTERN = r"\p{L}+|\p{N}{1,3}|[^\s\p{L}\p{N}]+"

# Characters trimmed from both ends of rubric names and texts.
WHITE_SPACE = " \t\r\n\f\u000b"
