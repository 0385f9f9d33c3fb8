"""qaloom: Spark jobs that build, score and audit question/answer training tables."""
