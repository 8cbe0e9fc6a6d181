"""Operators for preparing training corpora: near-duplicates, archives, licences,
language, decontamination, quality, repeated lines, shards, toxicity, packing, ranked search
and fill-in-the-middle.

Nothing else in the library imports this subpackage.
"""
