"""Writers: redacted packages, text reports."""
