"""Training-data operators: language ID, sharding, BPE, decontamination, near-dedup, media, counts, chat, licences, lines.

Nothing else in the library imports this subpackage; it imports nothing from the rest.
"""
