"""Training, search and scoring on the modelling matrix."""
