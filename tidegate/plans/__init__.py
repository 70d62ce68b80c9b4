"""Models, loads, metadata queries and ad hoc SQL built from the operators."""
