"""Training, evaluation, versioning and batch scoring with Spark ML."""
