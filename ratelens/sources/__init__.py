"""Readers, writers and the mapping of the retail tables to rating inputs."""
