"""The jobs users run, composed from sources, functions and operators."""
