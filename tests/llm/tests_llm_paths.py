"""Where the public tokenizer's file lies."""

import public_tokenizers

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
