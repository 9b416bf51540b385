"""Sizes of texts in tokens, from the core."""

from sparkloom.functions.tokens import PART, PATTERN, TOKENIZER, count, encoding, with_tokens  # noqa: F401
from sparkloom.functions.tokens import _parts  # noqa: F401
