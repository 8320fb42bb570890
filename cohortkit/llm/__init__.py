"""Operations on training corpora: search, quality, packing, encoding,
sharding, line and document de-duplication, fingerprints, archives, language.

Nothing else in the library imports this subpackage.
"""
