"""Jobs composed of several operators: reports, training and back-tests."""
