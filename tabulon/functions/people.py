"""Word lists for synthetic person columns."""

FIRST_NAMES = ["Ada", "Bela", "Carl", "Dina", "Emil", "Fay", "Gus", "Hana", "Ivo", "Jana", "Kurt", "Lena"]
LAST_NAMES = ["Abel", "Brook", "Crane", "Dale", "Ernst", "Field", "Grove", "Hill", "Irwin", "Jones", "Kerr"]
STREETS = ["Elm St", "Oak Ave", "Mill Rd", "Lake Dr", "High St", "Park Ln", "North Way"]
CITIES = ["Oakton", "Milford", "Ashby", "Denton", "Easton", "Fairview", "Granby", "Hadley"]
STATES = ["VA", "TX", "CA", "NY", "WA", "OR", "OH", "ME", "IA"]
MAIL_HOSTS = ["example.com", "example.org", "example.net"]
