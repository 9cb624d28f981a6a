"""Column-to-Column helpers; everything here stays inside Catalyst."""
