"""Made-up documents for the tests."""

GOOD = [
    "The harbour office opened a new ticket hall this week, and the first ferries left on time. Staff had moved into the "
    "building during the winter, with boxes of old records that nobody had read for years. The hall has wide doors, so that "
    "people with prams and bicycles can pass without waiting. A small shop sells maps and coffee to the early crowd. The "
    "manager said that the old hall will be turned into a library for the town by the end of summer.",
    "Baking bread at home takes time, but most of that time is waiting. Mix flour and water with a little salt, and let the "
    "dough rest for the night in a cool room. In the morning it should have doubled, and the surface will be full of bubbles. "
    "Fold the dough twice and leave it to rise again in the tin. Bake it in a hot oven until the crust is dark, and wait an "
    "hour before cutting the first slice.",
    "Our cycling club met at dawn to ride the old railway line to the coast. The track is flat and has been closed to cars "
    "since the last train left that valley. We stopped at a farm that sells cheese and apples to people on the way. Two of the "
    "riders had flat tyres, and the rest of us helped with pumps and patches. By noon we could be seen eating chips on the "
    "sea wall with the gulls looking on.",
    "A good notebook is the best tool that a young scientist can have. Write the date and the place at the top of each page, "
    "and note the weather to be safe. Draw what you see with a pencil, because ink runs in the rain. Keep the failed attempts, "
    "since they show the path of your thinking. After a year the pages will tell you more of your work than any computer.",
    "The museum has put its collection of clocks on show for the first time in a generation. Visitors walk through a dark room "
    "and hear the ticking of four hundred movements. Some of the clocks have to be wound by hand, and that takes a whole "
    "morning each week. Children like the one with the dancing bear the most. The show stays open to the end of October, with "
    "free entry on Mondays.",
    "Growing herbs on a balcony needs little more than light and patience. Choose pots that have holes in the base, and fill "
    "them with sandy soil. Water the plants in the evening so that the sun does not burn the leaves. Mint should be kept in a "
    "pot of its own, because its roots will take over the rest. Cut the stems often, and the plants will grow to be dense and "
    "strong.",
]
NEAR_COPY = GOOD[0].replace("by the end of summer", "by the end of autumn")
SHORT = ["Nothing to see here.", "This page has moved. Please try again.", "No entries. No entries. No entries."]
FRENCH = (
    "Le bureau du port a ouvert une nouvelle salle cette semaine, et les premiers bateaux sont partis dans les temps. Les "
    "portes sont larges pour que les gens avec des poussettes et des vélos puissent passer. Une petite boutique vend des "
    "cartes et du café. Le directeur dit que la vieille salle sera une bibliothèque pour la ville. Il est plus que content, "
    "et ne veut pas attendre au printemps pour les travaux sur le toit."
)
SPAM = "Buy it now! " * 13


def records():
    """Twelve: six good, a near copy of the first, three short, one French, one repetitive."""
    return [*GOOD, NEAR_COPY, *SHORT, FRENCH, SPAM]
