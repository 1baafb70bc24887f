"""Daily price-bar analytics and training features as Spark DataFrame functions."""
