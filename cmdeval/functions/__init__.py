from .text import (clean_command, cut_at_stop, last_line, lines, next_order, strip,
                   tokens)
from .metrics import (bleu4_from_counts, exact_match, f1_from_counts, multiset_overlap, next_codes,
                      output_chars, plain_number, round_exact, round_half_even, single_line, token_codes)

__all__ = [
    "clean_command", "cut_at_stop", "last_line", "lines", "next_order",
    "strip", "tokens", "bleu4_from_counts", "exact_match", "f1_from_counts",
    "multiset_overlap", "next_codes", "output_chars", "plain_number", "round_exact", "round_half_even", "single_line", "token_codes",
]
