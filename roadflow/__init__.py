"""roadflow: road-traffic analytics over floating car data as Spark DataFrame operators."""
