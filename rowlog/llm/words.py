"""Character classes of Latin text, for fast splitting with the standard `re`.

Fixed values: letters, digits and white space below U+0180, where every
Unicode version agrees. Texts with characters beyond are split by the
tokenizer library's own rules.
"""
from __future__ import annotations

import re

LETTER = "A-Za-zªµºÀ-ÖØ-öø-ſ"
NUMBER = "0-9²³¹¼-¾"
SPACE = "\t\n\v\f\r \u0085\u00a0"

beyond_latin = re.compile("[^\\x00-ſ]").search
