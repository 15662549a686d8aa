"""Operations of a training-data pipeline: deduplication, tokenizing, filtering, extraction."""
