"""Where data comes from and where tables go."""
