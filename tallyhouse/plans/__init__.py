"""The warehouse build, the business questions and the quality checks."""
