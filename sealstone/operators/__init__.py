"""DataFrame operators: photos, seals, faces, verdicts, reports and pixel grids."""
