"""Column helpers and the building blocks that keep hot groups out of single tasks."""
