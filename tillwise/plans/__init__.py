"""The pipeline steps, each built from operators."""
