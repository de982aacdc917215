"""Operations on training text: scoring, deduplication, search, packing and filters."""
