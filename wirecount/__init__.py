"""wirecount: counts what the news wire is talking about, on Spark."""
