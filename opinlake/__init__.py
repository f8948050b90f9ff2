"""opinlake: a Spark-first engine for public-opinion text (posts, comments, articles, videos)."""
