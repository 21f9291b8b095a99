"""Operations of a training-data pipeline: one module per operator, its queries in `queries`."""
