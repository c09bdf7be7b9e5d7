"""Column functions and window helpers shared by the operators."""
