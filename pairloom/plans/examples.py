"""Parameters shared by the registered queries and their SQL counterparts."""

from pairloom.functions.text import DELIMITER

SPECIALS = [DELIMITER, "<|user|>", "<|assistant|>", DELIMITER + DELIMITER]

# A merge list in rank order, "left right" in hex.
_MERGES = """
    74 68, 20 65, 20 7468, 6F 6E, 69 6E, 72 65, 20 61, 74 69,
    65 72, 68 65, 6E 64, 6C 65, 65 6E, 20 C3, 20 6F, 63 68,
    73 74, 2065 72, 207468 65, 61 6E, 20 64, 7469 6F6E, 68 61, 2065 6E,
    6F 75, 20 6F6E, 696E 67, 6C 79, 6F 72, 6E 74, 61 74, 62 6C65,
    65 61, 77 68, 65 73, 73 68, 2061 6E, 206F 66, 75 65, 20 7265,
    69 74, 63 69, 20 696E, C3 B3, 69 65, 20C3 A9, 65 64, 20 74,
    20 6865, 25 25, 6369 C3B3, 26 26, 71 7565, 75 78, 2A 2A, 2061 6E64,
    C3 A9, 6369C3B3 6E, 656E 74, 20 7C, 6D 656E74, 20 6C, 24 24, 2064 65,
"""
MERGES = [tuple(pair.split()) for pair in _MERGES.strip().rstrip(",").split(",")]
SHORT_MERGES = MERGES[:24]

TRAIN_MERGES = 24
TRAIN_STEP = 8

# A run over many stored bases, stopped and resumed on the way.
LONG_MERGES = 243
LONG_STOP = 120

# Put after texts by turns: white space of several kinds, overlapping specials, runs, rare characters.
EDGES = [
    "",
    " ",
    "  \u3000\u3000x",
    "\u00a0\u00a0x \u00a0",
    "a\u2028\u2028b\u0085\u0085c",
    "aaaa aaaaa",
    DELIMITER + DELIMITER + DELIMITER,
    "<|" + DELIMITER + "|>",
    "\t\n\r\n  the\n",
    "\u0000\u007f\U0010ffff\U0001f600",
    "'s'll 'T 12\u0664\u00bd",
    "e\u0301\u200d\ufeff",
]

# A vocabulary with gaps: only the first merges have ids, and two bytes have none.
KNOWN_MERGES = 12
ABSENT_BYTES = ("0A", "C3")
