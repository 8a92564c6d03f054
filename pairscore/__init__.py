"""Quality estimation for aligned sentence pairs on Spark."""
