"""quizmill: assessment-bank building and checking on Spark."""

__version__ = "0.1.0"
