"""Test input (event logs built from the driver tables) and the registered
queries that run the engine on it. The engine does not import this package."""
