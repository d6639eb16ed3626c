"""Real words that are one edit from a lexicon word of the abuse operator; they are never read as its misspelling."""

# Fixed values, chosen by hand and from the words of program documentation.
NEIGHBOURS = frozenset(
    """
    accident actions animal arm auction bac baca backs bah bak band barn bat batch beast beats bed bedrooms beet ben bends best bet beta biest bind birch bis bit bits black
    blend blocks bloods bloody boa boat bond bone boned bonus boo boost boots born bot botch bread breaks bred breeds broke buck bun burns burnt butch cake calas calla cam
    camel cancers cane cans cant case cases cent choked chokes clan cleans clearn clicks clock cluck cocks cocky codes coed coke cola come count county cranks cranky crash
    crashed creme crimea crimes cripple crippled crushes das day dayes deck deserved deserves destroys dicky dirt disappears diseased diseases ditch dock drive dub duck dug
    dumbo dummen eye eyed fac faced facer faces facet fade fair fare favors favours feels fenced fences fermer fiend fin finds fine fined finger fins fire firme flavor
    flavour foca foil folder fond fonda font foo fools foreigner forme foul fronts fuel fund gags gas gave gay god gods gold goo goods goys grace gravel graves grays grove
    guys had half hall halts halve han handling hands handy happens hart hat haven haves heads heady hear heard hello help hijos hill hive hoe hole hop hoped hopes hops horn
    hose housed houses hove hull hurts hut immigrant inferiors info insides interior intro jaws jew jumps keel keeps kicks kid kills kilo kinda kinds kiss kitchens knee kneed
    knew known knows krill lags laps laser lasers leach lech leg lets life lip lisp lived lives logs looser lose loses love lower lowers mat merdes mere migrant money monkeys
    moon moran morn moth mothers mourns mouths muslim muslins named nase necks nest net nick node nodes noise noses nudge nudges officer offices opinions overt oxygens pale
    pass pauta pick picks pie pieces pierce pies piles pipe plagued plagues pole porras porta pricks pron punchy punta puss put putas puts refugee refuges regard regards rib
    robs rounds rubs savage savaged scam schlaf scrape scraper scrapes scree screws scrum seal sep shatters she shift ships shirt shone shoots shop shore shores short shots
    shouldn shove show shows shunt shuts sic sin sink sip sit skein ski skid skill skins skipped skirts skit skulls sled slide slits slot slots smasher smashes snaps snip
    solid spaced spacer spaces spade spec spend spica spice spit split spreads stabs staffs stag stank steak steals steel steep steps stinks stinky stop strange streets strep
    stub stuff stunk suffers suit sum surfer tall tame tap tarp tats tea teams teem teethe tell theirs theme then these thin things thrash threat throats throw thrusts tie
    tim timed timer times tine ting tit titis titus toll tome tongues tots track trains tram traps trashy trick trip trucks trust trusting tuck twit typed types typo vette
    vote wan wants wasted wastes wat weeps went were witch woken woman wont wore yours zorras zorro showed same recorded though here lack returned counts dummy ridge drives careless dos dancers mild diet chronic bats workers rapid finches scale quite trace match
    down drawn leaves most fell halfway will prey far hate ever beach cost hold but bullocks bustards hunter hunters counter showing shower shoving quote quiet quota dread
    дураки скука стука сутки тупо
    """.split()
)
