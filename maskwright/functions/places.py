"""The parts replacement addresses are put together from."""

STREETS = (
    "Acorn", "Alder", "Aspen", "Bayview", "Beech", "Birch", "Bridge", "Canal", "Cedar",
    "Chapel", "Cherry", "Church", "Clover", "Cypress", "Elm", "Fern", "Garden", "Grove",
    "Harbor", "Hazel", "Hickory", "Hill", "Ivy", "Juniper", "Lake", "Laurel", "Linden",
    "Magnolia", "Maple", "Meadow", "Mill", "Oak", "Orchard", "Park", "Pine", "Poplar",
    "Ridge", "River", "Spruce", "Spring", "Sunset", "Sycamore", "Valley", "Walnut", "Willow",
)

STREET_TYPES = (
    "Avenue", "Boulevard", "Circle", "Court", "Drive", "Lane", "Place", "Road", "Square",
    "Street", "Terrace", "Way",
)

CITIES = (
    "Ashford", "Bayside", "Brookfield", "Clearwater", "Clifton", "Crestview", "Dayton",
    "Eastport", "Edgewood", "Fairview", "Farmington", "Franklin", "Glendale", "Greenville",
    "Hampton", "Harrison", "Highland", "Kingston", "Lakewood", "Lexington", "Madison",
    "Manchester", "Milford", "Milton", "Newport", "Northfield", "Oakdale", "Oxford",
    "Pleasantville", "Riverside", "Salem", "Springfield", "Stratford", "Sunnyvale", "Union",
    "Waterford", "Westbrook", "Winchester", "Woodland", "Yorktown",
)

# Two-letter postal codes of the states of the USA.
STATES = (
    "AL", "AK", "AZ", "AR", "CA", "CO", "CT", "DE", "FL", "GA", "HI", "ID", "IL", "IN", "IA",
    "KS", "KY", "LA", "ME", "MD", "MA", "MI", "MN", "MS", "MO", "MT", "NE", "NV", "NH", "NJ",
    "NM", "NY", "NC", "ND", "OH", "OK", "OR", "PA", "RI", "SC", "SD", "TN", "TX", "UT", "VT",
    "VA", "WA", "WV", "WI", "WY",
)
