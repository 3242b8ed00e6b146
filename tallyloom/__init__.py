"""Text, pair, ratings, graph, search and stream analytics as Spark jobs."""
