"""Named query plans (the registry the driver runs) and plan checks."""
