"""External services: the state of a pool of keys, retries, and the stages' gates."""
