"""Operations of a training-data pipeline, each a module of its own; nothing else in the library imports this package."""
