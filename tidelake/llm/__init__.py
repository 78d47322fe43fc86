"""Training-data operators: dedup, classifiers, media, mixing, chat, decontamination, tokens, sharding."""
