"""Tables, models and the model registry: everything that touches storage."""
