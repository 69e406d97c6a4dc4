"""Vocabulary files and the ids the registered queries use."""

import public_tokenizers

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
PATTERN = public_tokenizers.PATTERN
#: Free id above the ranks.
END_OF_DOCUMENT = 50_256
