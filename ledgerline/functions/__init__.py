"""Pure Column builders: the domain classifiers of the reports."""
