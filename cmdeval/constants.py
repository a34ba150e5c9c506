"""Fixed values.

Everything in the block below must equal the behaviour being reproduced for
results to agree: the system sentence, the chat markers, the column aliases,
Python's whitespace set, the token pattern and the metric parameters.
Do not edit them to make a test pass.
"""

# ---- fixed values --------------------------------------------------------

SYSTEM_PROMPT = (
    "You are a Linux and Ubuntu terminal assistant. Return only the exact, "
    "executable Bash command matching the user request with no markdown "
    "formatting or conversational filler."
)

IM_START = "<|im_start|>"
IM_END = "<|im_end|>"

# Training-pair column aliases, first present one wins.
INSTRUCTION_ALIASES = ("prompt", "instruction", "input", "question")
COMMAND_ALIASES = ("completion", "command", "output", "response")

# Code points for which Python's str.isspace() is true (Python 3.13).
PY_WHITESPACE_CODEPOINTS = (
    0x09, 0x0A, 0x0B, 0x0C, 0x0D, 0x1C, 0x1D, 0x1E, 0x1F, 0x20, 0x85, 0xA0,
    0x1680, 0x2000, 0x2001, 0x2002, 0x2003, 0x2004, 0x2005, 0x2006, 0x2007,
    0x2008, 0x2009, 0x200A, 0x2028, 0x2029, 0x202F, 0x205F, 0x3000,
)

# Blank-line test of the `ask` filter: POSIX [[:space:]] once \r and \n are gone.
POSIX_BLANK = " \t\x0b\x0c"

# Python `\w+|[^\w\s]` with Unicode classes, written for Java regex and RE2:
# word = [\p{L}\p{N}_], space = [\x09-\x0d\x1c-\x20\x{85}\p{Z}].
TOKEN_PATTERN = r"([\p{L}\p{N}_]+|[^\p{L}\p{N}_\x09-\x0d\x1c-\x20\x{85}\p{Z}])"
CODE_FENCE = "```"
COMMENT_MARK = "#"

BLEU_MAX_ORDER = 4
BLEU_WEIGHT = 0.25
BLEU_SMOOTHING = 0.1
BLEU_DIGITS = 12  # per-pair BLEU is rounded here so engines agree bit for bit

SINGLE_LINE_MAX_LINES = 2
SYNTAX_TIMEOUT_SEC = 2.0

SEQ_BUDGET_TOKENS = 2048
TRAIN_SEED = 3407
TRAIN_BATCH_SIZE = 4
TRAIN_GRAD_ACCUM = 4
TRAIN_MAX_STEPS = 300

LOG_TAIL_LINES = 30

# Report rows: (summary column, display name, unit suffix, kind).
REPORT_METRICS = (
    ("exact_match_pct", "**Exact Match (EM %)**", "%", "delta"),
    ("mean_token_f1", "**Token F1 Score**", "", "delta"),
    ("mean_bleu4", "**BLEU-4 Score**", "", "delta"),
    ("syntax_validity_pct", "**Bash Syntax Validity**", "%", "delta"),
    ("single_line_clean_pct", "**Zero-Chatter / Clean Format**", "%", "delta"),
    ("avg_latency_sec", "**Mean Latency (sec)**", "s", "faster"),
)

# Report table head: the header with the two models' labels, and the rule below it.
REPORT_HEADER = "| Metric | Base Model ({base}) | Fine-Tuned Model ({tuned}) | Improvement |"
REPORT_RULE = "| :--- | :--- | :--- | :--- |"

# Metrics that a short report shows; the full one shows all.
SHORT_REPORT = ("exact_match_pct", "mean_token_f1", "syntax_validity_pct", "avg_latency_sec")

# ---- end of fixed values -------------------------------------------------



def word_ranges(first: int = 0x370, last: int = 0x2FFFF) -> str:
    """Character ranges of Python's alphanumeric characters, for a Java character class: its own classes of letters
    and numbers are those of the Unicode version that the JVM was built with."""
    out, start = [], None
    for c in range(first, last + 2):
        word = c <= last and not 0xD800 <= c < 0xE000 and chr(c).isalnum()
        if word and start is None:
            start = c
        elif not word and start is not None:
            out.append(f"\\x{{{start:x}}}-\\x{{{c - 1:x}}}")
            start = None
    return "".join(out)


# The same tokens for Java regex, without the group and with a possessive run (the two alternatives are disjoint,
# so no match changes; RE2 lacks `++`). Characters below the ranges don't look at them.
_WORD = r"\p{L}\p{N}_[\x{370}-\x{2ffff}&&[" + word_ranges() + "]]"
TOKEN_PATTERN_JAVA = rf"[{_WORD}]++|[^{_WORD}\x09-\x0d\x1c-\x20\x{{85}}\p{{Z}}]"

# And for Python's own regular expressions.
TOKEN_PATTERN_PYTHON = r"\w+|[^\w\s]"

PY_WHITESPACE = "".join(chr(c) for c in PY_WHITESPACE_CODEPOINTS)
ROWS_PER_STEP = TRAIN_BATCH_SIZE * TRAIN_GRAD_ACCUM
