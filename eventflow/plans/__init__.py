"""Filter chains: specification, compilation, audit and routing."""
