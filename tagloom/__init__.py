"""tagloom: user tags, scores and profiles as Spark DataFrame jobs."""
