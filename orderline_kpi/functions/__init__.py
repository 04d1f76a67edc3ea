"""Column builders: measures, calendar keys, ratios and labels."""
