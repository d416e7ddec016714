"""Column-level helpers: money (``money``), calendar (``calendar``) and
audience rules (``rules``)."""
