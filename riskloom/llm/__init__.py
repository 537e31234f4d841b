"""Operations of a training-data pipeline on Spark. Nothing else in the library imports them."""
