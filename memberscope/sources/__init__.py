"""Inputs and outputs: table loading and domain views (``tables``), text
lines (``text``), SQL views (``views``) and sinks (``sinks``)."""
