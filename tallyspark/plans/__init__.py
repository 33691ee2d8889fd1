"""Models: staging (M1-M9), reconciliation and attribution (M10-M11),
marts (M12-M16), quality suite (Q1-Q14), reports and tie-outs (D-1..D-11)."""
