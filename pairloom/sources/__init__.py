"""Reading and writing corpora, tokenizers and checkpoints."""
