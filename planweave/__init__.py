"""A PySpark engine that turns annotated floor-plan drawings into classified regions."""
