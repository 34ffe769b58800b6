"""Training-data operators (decontamination, dedup, tokenisation, quality, safety). Nothing outside imports this."""
