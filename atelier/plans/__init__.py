"""Plan-document contract validators and physical-plan checks."""
