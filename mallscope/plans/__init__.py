"""End-to-end results R1-R8 and the reports job."""
