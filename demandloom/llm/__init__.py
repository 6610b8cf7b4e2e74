"""Operations of a training-data pipeline as Spark jobs; nothing else in the library imports them."""
